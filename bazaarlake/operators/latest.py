"""Latest version per key, and merging late changes into an already unique snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest ``order`` tuple wins.

    The rank filter becomes a WindowGroupLimit below the shuffle, so each map task ships at most one row per
    key; a key holding most of the log costs no more than any other.
    """
    window = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def merge_on_read(snapshot: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_by_key(snapshot + changes)`` for a snapshot that is already unique on ``key``.

    The snapshot is the big side. It is read twice, once for its key and rank only, and a column that is not asked for is
    not read. As long as the day's changes are small enough for the planner to broadcast, it is never shuffled;
    beyond that the joins fall back to sort-merge on the unique key.
    """
    newest = latest_by_key(changes, key, order)
    rank = F.struct(*[F.col(c) for c in order])
    on_key = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_k_{k}") for k in key], rank.alias(name))

    offered = side(newest, "_offered")
    kept = snapshot.join(offered, [*on_key, F.col("_offered") > rank], "left_anti")
    held = snapshot.select(*dict.fromkeys([*key, *order])).join(offered, on_key, "left_semi")
    taken = newest.join(side(held, "_held"), [*on_key, F.col("_held") >= rank], "left_anti")
    return kept.unionByName(taken)
