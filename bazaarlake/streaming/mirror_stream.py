"""The incremental mirror fed by Structured Streaming instead of a cursor."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.operators.bucket_mirror import BucketMirror
from bazaarlake.operators.latest import latest_by_key

#: Landed files that a micro-batch takes at most.
FILES_PER_BATCH = 1000


def pull_available(
    spark: SparkSession,
    landing: str,
    schema,
    select: Callable[[DataFrame], DataFrame],
    root: str,
    files_per_batch: int | None = None,
) -> None:
    """Append every landed file not seen yet to the log below ``root``, then stop.

    The stream's own checkpoint remembers the files, so it takes the place of the high-water mark and late
    rows cannot fall behind it. The file sink commits whole batches; a repeated batch is not doubled.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = select(reader.parquet(landing)).withColumn("loaded_at", F.current_timestamp())
    query = (
        rows.writeStream.format("parquet")
        .option("path", f"{root}/log")
        .option("checkpointLocation", f"{root}/_stream")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current(spark: SparkSession, root: str, key: Sequence[str], cursor: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: newest cursor, then last loaded."""
    log = spark.read.parquet(f"{root}/log")
    return latest_by_key(log, key, [cursor, "loaded_at", *ties]).drop("loaded_at")


def feed(
    spark: SparkSession,
    landing: str,
    schema,
    select: Callable[[DataFrame], DataFrame],
    mirror: BucketMirror,
    checkpoint: str,
    stream: str = "landing",
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Append every landed file not seen yet to a mirror that batch loads and compactions may use at the same time, then stop.

    The backlog is taken in micro-batches of bounded size. The mirror's commit holds the last epoch of the stream, so a micro-batch
    that is repeated after a failure, before or after its commit, is in the mirror once.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)

    def append(batch: DataFrame, epoch: int) -> None:
        mirror.append(batch, stream, epoch)

    query = (
        select(reader.parquet(landing))
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
