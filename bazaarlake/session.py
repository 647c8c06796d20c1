"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


#: Width of a shuffle before AQE merges partitions up to the advisory size. AQE never widens a plain shuffle, so this bounds
#: a task's share: at 100 TB about 12 GB of a shuffle of everything. Raise it with the data, lower it for small tests.
SHUFFLE_PARTITIONS = "8192"


def build_session(app: str = "bazaarlake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are written for.

    The shuffle width starts high and AQE coalesces it to partitions of about 128 MB, so the same
    setting serves a laptop and a cluster; callers override it through ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", SHUFFLE_PARTITIONS)
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")  # split a hot key even if that costs another shuffle
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.files.maxPartitionBytes", "256m")
        .config("spark.sql.files.openCostInBytes", "1m")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run's tables, below the shared folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only where it is unset, as in local tests, is a
    temporary folder made and remembered for the session.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="bazaarlake-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/bazaarlake/{purpose}-{uuid.uuid4().hex}"
