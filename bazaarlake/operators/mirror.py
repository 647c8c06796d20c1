"""Incremental mirror of a source table: append changed rows, keep the latest row per key."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaarlake.operators.latest import latest_by_key, merge_on_read
from bazaarlake.sources import storage
from bazaarlake.sources.commits import CommitConflict, CommitLog
from bazaarlake.sources.extract import EPOCH, changed_since, utc_literal


def high_water(log: DataFrame, table: str) -> DataFrame:
    """The largest recorded ``last_write_date`` of a table, the epoch when it never ran."""
    return log.where(F.col("table_name") == table).agg(
        F.coalesce(F.max("last_write_date"), utc_literal(EPOCH)).alias("last_write_date")
    )


def batch_high_water(batch: DataFrame, cursor: datetime, column: str = "write_date") -> DataFrame:
    """New mark (never below the old one) and row count of a batch in one aggregate."""
    return batch.agg(
        F.greatest(F.max(F.col(column).cast("timestamp")), utc_literal(cursor)).alias("last_write_date"),
        F.count(F.lit(1)).alias("rows_loaded"),
    )


#: How often a load that others overtake starts again.
ATTEMPTS = 10


class Mirror:
    """One mirrored table below ``root``: a batch log, compacted snapshots and a log of runs.

    A row's rank is (write_date, batch, tie columns). A load writes its batch to a folder of its own, then commits its run under the next
    number; the commit names the folder. Of two loads at once one has the number; the other drops its batch and starts again from
    the new mark. Only batches of committed runs are read or compacted. ``BucketMirror`` is the one to use for tables too large to merge by a shuffle.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        table: str,
        key: Sequence[str] = ("id",),
        cursor: str = "write_date",
        ties: Sequence[str] = (),
    ):
        self.spark = spark
        self.table = table
        self.key = list(key)
        self.cursor = cursor
        self.order = [cursor, "batch_id", *ties]
        self._log = f"{root}/{table}/log"
        self._snapshots = f"{root}/{table}/snapshot"
        self.runs = CommitLog(spark, f"{root}/{table}/runs")

    def checkpoint_log(self) -> DataFrame:
        """Every run ever committed, empty runs included."""
        notes = self.runs.notes("mark bigint, rows bigint, at bigint")
        return notes.select(
            F.lit(self.table).alias("table_name"),
            F.timestamp_micros("mark").alias("last_write_date"),
            F.col("rows").alias("rows_loaded"),
            F.timestamp_micros("at").alias("run_ts"),
        )

    def load(
        self,
        source: DataFrame,
        select: Callable[[DataFrame], DataFrame] = lambda df: df,
        lookback: timedelta | None = None,
    ) -> int:
        """Append the rows changed since the last run, commit the run, return the row count.

        The new mark and the count are observed while the batch is written; the batch is read once.
        """
        for _ in range(ATTEMPTS):
            number, state = self.runs.head()
            before = state["mark"] if state else 0
            changed = select(changed_since(source, EPOCH + timedelta(microseconds=before), self.cursor, lookback))
            seen = Observation()
            observed = changed.observe(
                seen,
                F.max(F.unix_micros(F.col(self.cursor).cast("timestamp"))).alias("mark"),
                F.count(F.lit(1)).alias("rows"),
            )
            attempt = uuid.uuid4().hex
            storage.append_batch(observed, self._log, f"{number + 1}/attempt={attempt}")
            run = {"mark": max(before, seen.get["mark"] or 0), "rows": seen.get["rows"], "at": int(time.time() * 1_000_000)}
            if self.runs.commit(number + 1, {"mark": run["mark"]}, run | {"number": number + 1, "attempt": attempt}):
                storage.mark_committed(self.spark, f"{self._log}/batch_id={number + 1}")
                return run["rows"]
            storage.drop_folder(self.spark, self._batch(number + 1, attempt))
        raise CommitConflict(f"{self.table}: {ATTEMPTS} loads in a row were overtaken")

    def _batch(self, number: int, attempt: str) -> str:
        return f"{self._log}/batch_id={number}/attempt={attempt}"

    def _batches(self, after: int = 0) -> DataFrame | None:
        """Batches of committed runs above a number, with their ``batch_id``; those trimmed away are left out."""
        runs = self.runs.notes("number bigint, attempt string").where(F.col("number") > after).collect()
        paths = [p for p in (self._batch(r["number"], r["attempt"]) for r in runs) if storage.exists(self.spark, p)]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", self._log).parquet(*paths).drop("attempt")
        return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))

    def log(self) -> DataFrame:
        """All versions ever loaded."""
        return self._batches()

    def current(self) -> DataFrame:
        """One row per key: the last compacted snapshot with the later batches merged in."""
        done = storage.numbered_children(self.spark, self._snapshots, "upto")
        if not done:
            return latest_by_key(self.log(), self.key, self.order).drop("batch_id")
        snapshot = self.spark.read.parquet(f"{self._snapshots}/upto={done[-1]}")
        changes = self._batches(done[-1])
        if changes is None:
            return snapshot.drop("batch_id")
        return merge_on_read(snapshot, changes, self.key, self.order).drop("batch_id")

    def compact(self, trim_log: bool = False) -> None:
        """Write the current rows as a new snapshot. The one before stays for readers still on it.

        With ``trim_log`` the batches already held by that earlier snapshot are deleted from the log.
        """
        batches = self.runs.numbers()
        done = storage.numbered_children(self.spark, self._snapshots, "upto")
        if not batches or (done and done[-1] == batches[-1]):
            return
        if done:
            snapshot = self.spark.read.parquet(f"{self._snapshots}/upto={done[-1]}")
            changes = self._batches(done[-1])
            rows = merge_on_read(snapshot, changes, self.key, self.order)
        else:
            rows = latest_by_key(self.log(), self.key, self.order)
        rows.write.mode("overwrite").parquet(f"{self._snapshots}/upto={batches[-1]}")
        if done:
            storage.drop_children(self.spark, self._snapshots, "upto", done[-1] - 1)
            if trim_log:
                storage.drop_children(self.spark, self._log, "batch_id", done[-1])


def full_refresh(df: DataFrame, root: str) -> DataFrame:
    """Replace the stored table by the source as it is now, deletes included, and read it back."""
    storage.publish(df, root)
    return storage.read_published(df.sparkSession, root)
