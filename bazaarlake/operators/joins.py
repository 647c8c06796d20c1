"""Joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(
    df: DataFrame, keys: Sequence[str], row_key: Sequence[str], probe: int = 64, rows_per_copy: int = 10_000_000
) -> DataFrame:
    """Keys of about ``rows_per_copy`` rows or more, with the number of copies each is to be split into.

    Every ``probe``-th row by the hash of its own id is counted: a pure function of the row, so a retried or
    repeated evaluation finds the same keys. There are at most rows / ``rows_per_copy`` of them. The scan reads the
    keys of all rows: store the result and hand it to ``skew_join`` run after run.
    """
    probed = (
        df.where(F.pmod(F.xxhash64(*row_key), F.lit(probe)) == 0)
        .where(~_any(F.col(k).isNull() for k in keys))
        .groupBy(*keys)
        .agg((F.count(F.lit(1)) * probe).alias("_rows"))
    )
    copies = F.ceil(F.col("_rows") / F.lit(rows_per_copy)).cast("int").alias("_copies")
    return probed.where(F.col("_rows") >= rows_per_copy).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], copies)


def fits_broadcast(*frames: DataFrame) -> bool:
    """Whether the planner's size estimates of the frames add up to less than its own broadcast threshold."""
    conf = frames[0].sparkSession._jsparkSession.sessionState().conf()
    sizes = [int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in frames]
    return sum(sizes) <= conf.autoBroadcastJoinThreshold()


def skew_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[tuple[str, str]],
    row_key: Sequence[str],
    how: str = "inner",
    joined_from: Sequence[DataFrame] = (),
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``many`` to ``one`` (unique on its key) where some keys of ``many`` hold a large share of its rows.

    If ``one`` is small enough to be broadcast, ``many`` is not shuffled and a plain join is all it takes. Otherwise both
    sides are merged on the key. AQE splits the partition of a hot key by map output and gives every piece the one matching
    row, so neither side is read beforehand to look for such keys. NULL keys, which match nothing, are spread by row.
    Keys known to be hot may be listed in ``hot`` (see ``hot_keys``): their rows get a salt from their own id and the
    matching row of ``one`` is copied once per salt.

    Where ``one`` is itself a one-to-one join, the planner takes the product of its inputs' sizes for its size.
    ``joined_from`` names these inputs; their sum is checked instead.
    """
    cond = [F.col(m) == F.col(o) for m, o in on]
    if fits_broadcast(*(joined_from or (one,))):
        return many.join(F.broadcast(one) if joined_from else one, cond, how)
    if how == "inner" and hot is None:
        return many.join(one, cond, how)
    many_keys = [m for m, _ in on]

    def with_copies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
        if hot is None:
            return df.withColumn("_copies", F.lit(1))
        same = [F.col(c) == F.col(f"_hot_{m}") for c, m in zip(cols, many_keys, strict=True)]
        found = df.join(F.broadcast(hot), same, "left").drop(*[f"_hot_{m}" for m in many_keys])
        return found.withColumn("_copies", F.coalesce("_copies", F.lit(1)))

    spread = F.xxhash64(*row_key)
    any_null = _any(F.col(m).isNull() for m in many_keys)
    salt = F.when(any_null, F.pmod(spread, F.lit(4096))).otherwise(F.pmod(spread, F.col("_copies"))).cast("int")
    salted = with_copies(many, many_keys).withColumn("_salt", salt)
    copied = with_copies(one, [o for _, o in on])
    copied = copied.withColumn("_one_salt", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)) if hot is not None else F.lit(0))
    cond = [*cond, F.col("_salt") == F.col("_one_salt")]
    return salted.drop("_copies").join(copied.drop("_copies"), cond, how).drop("_salt", "_one_salt")


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def missing_parents(child: DataFrame, fk: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Per foreign key value without a parent, the number of child rows. NULL keys pass.

    Child rows are counted per key first, so the anti join sees each key once however often it occurs.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(parent.select(F.col(parent_key).alias("_pk")), F.col("_fk") == F.col("_pk"), "left_anti")
