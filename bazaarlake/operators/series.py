"""Row multiplication, numbering within a group, and per-group samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.operators.joins import skew_join


def explode_series(df: DataFrame, n: Column, name: str) -> DataFrame:
    """Each row n times, numbered 1..n; no row for n = 0 (a bare ``sequence(1, 0)`` would count down)."""
    return df.withColumn(name, F.explode(F.when(n > 0, F.sequence(F.lit(1), n))))


def number_within(
    df: DataFrame, group: Sequence[str], bucket: Column, order: Sequence[str], name: str, size: str
) -> DataFrame:
    """``row_number()`` over ``group`` ordered by (bucket, order), and the group's size.

    A group is numbered in as many pieces as it has buckets and the pieces are put together with running
    piece sizes, so no task ever holds a whole large group if ``bucket`` takes more values in larger groups.
    """
    split = df.withColumn("_bucket", bucket)
    piece = [*group, "_bucket"]
    local = split.withColumn("_at", F.row_number().over(Window.partitionBy(*piece).orderBy(*order)))

    per_group = Window.partitionBy(*group)
    before = per_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = split.groupBy(*piece).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        *piece,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(per_group).alias(size),
    )
    return (
        local.join(offsets, piece)
        .withColumn(name, F.col("_before") + F.col("_at"))
        .drop("_bucket", "_at", "_before")
    )


#: Steps of the pseudo-random numbers that subsets are drawn with: a prime modulus and two multipliers.
SUBSET_MODULUS, SUBSET_SEED, SUBSET_STEP = 2_147_483_647, 48_271, 1_664_525


def subset_number(seed: Column, step: Column) -> Column:
    """A pseudo-random number below ``SUBSET_MODULUS`` for a request's ``step``-th choice, in plain arithmetic."""
    mixed = F.pmod(F.pmod(seed, F.lit(SUBSET_MODULUS)) * SUBSET_SEED + step * SUBSET_STEP + 1, F.lit(SUBSET_MODULUS))
    return F.pmod(mixed * SUBSET_SEED + F.floor(mixed / 65_536).cast("bigint"), F.lit(SUBSET_MODULUS))


def random_subset(seed: Column, k: Column, m: Column) -> Column:
    """An array of ``k`` different numbers from 0 to m - 1 in which every subset is as likely as any other.

    Floyd's method: for j = m - k, ..., m - 1 draw a number up to j, and take j itself if that one is taken already. It needs k
    draws and no further try, however close k is to m.
    """
    steps = F.when(k > 0, F.sequence(F.lit(0).cast("bigint"), k.cast("bigint") - 1)).otherwise(F.array().cast("array<bigint>"))

    def add(chosen: Column, i: Column) -> Column:
        j = m.cast("bigint") - k.cast("bigint") + i
        drawn = F.pmod(subset_number(seed, i), j + 1)
        return F.array_append(chosen, F.when(F.array_contains(chosen, drawn), j).otherwise(drawn))

    return F.aggregate(steps, F.array().cast("array<bigint>"), add)


def sample_k_per_group(
    requests: DataFrame,
    items: DataFrame,
    group: str,
    k: Column,
    start: Column,
    shuffle_key: Column,
    item_key: str,
    request_key: str,
    buckets: int = 64,
    rows_per_copy: int = 1_000_000,
    rows_per_piece: int = 1_000_000,
    independent: bool = False,
) -> DataFrame:
    """For each request, k distinct items of its group without building all request-item pairs.

    A group's items are put in a hashed order and numbered once; a request takes k neighbours on that ring,
    beginning at ``start`` modulo the group's size. With ``independent`` its items are a random subset of their own instead, see
    ``random_subset``; ``start`` is its seed then. Groups with fewer than k items give all they have;
    requests of groups without items give no row. Both inputs are read several times and should be stored
    tables. Where many requests share few items, the items are copied
    once per ``rows_per_copy`` expected picks and the picks spread over the copies. A group is numbered in ``buckets``
    pieces, or more where these would exceed ``rows_per_piece``; ``shuffle_key`` should take many more values than that.
    """
    asked = requests.withColumns({"_k": k, "_start": start})
    demand = asked.groupBy(F.col(group).alias("_g")).agg(F.sum("_k").alias("_picks"))
    supply = items.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_m"))
    groups = supply.join(demand, "_g").select(
        "_g", "_m", F.greatest(F.lit(1), F.ceil(F.col("_picks") / (F.col("_m") * rows_per_copy))).alias("_spread")
    )

    sized = skew_join(asked, groups, [(group, "_g")], [request_key]).drop("_g")
    taken = F.least("_k", "_m").cast("int")
    if independent:
        chosen = random_subset(F.col("_start"), taken, F.col("_m"))
        picks = sized.select("*", F.posexplode(chosen).alias("_at", "_want"))
        picks = picks.withColumn("pick", F.col("_at") + 1).withColumn("_want", F.col("_want") + 1)
    else:
        picks = explode_series(sized, taken, "pick")
        picks = picks.withColumn("_want", F.pmod(F.col("_start") + F.col("pick") - 1, F.col("_m")) + 1)
    picks = picks.select(
        *requests.columns,
        "pick",
        "_want",
        F.pmod(F.xxhash64(request_key, "pick"), F.col("_spread")).alias("_salt"),
    )

    listed = skew_join(items, groups, [(group, "_g")], [item_key, group]).drop("_g")
    listed = listed.withColumn("_mix", shuffle_key)
    pieces = F.greatest(F.lit(buckets), F.ceil(F.col("_m") / rows_per_piece))
    slots = number_within(listed, [group], F.col("_mix") % pieces, ["_mix", item_key], "_pos", "_size")
    slots = slots.withColumn("_one_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_spread") - 1)))
    slots = slots.withColumnRenamed(group, "_item_group").drop("_mix", "_size", "_spread", "_m")
    cond = [
        F.col(group) == F.col("_item_group"),
        F.col("_want") == F.col("_pos"),
        F.col("_salt") == F.col("_one_salt"),
    ]
    return picks.join(slots, cond).drop("_item_group", "_pos", "_want", "_salt", "_one_salt")
