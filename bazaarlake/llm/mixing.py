"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Every source gets a target number of words. A document is first taken whole as often as its source's ratio of
target to size has whole units. What is left of the target is drawn by Pareto order sampling: a document's rank is
its random odds u / (1 - u) divided by its inclusion odds, and the documents of lowest rank are taken until the
words are used up (a sample of fixed size, measured in words). Multiplying all inclusion odds of a source by one
number leaves the order as it is, so only their proportions need to be known.

At scale: the ranks are never sorted per source. They are counted into a fixed number of bins per source, the bin
in which the target is reached follows from the bins' sums, and only that bin (a 4096th of the source) is ordered.
A row's random number is made of its id. Rows that repeat an id (or, without one, a text) get numbers of their own from
their text, source and place among rows alike, so that no two rows share a rank and a target is met to within a document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import WORD, cut, fresh, occurrences, small

BINS = 4096
SEED = "mix-1"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def default_preference(size: Column) -> Column:
    """Inclusion odds of a document: twice as high from 64 words on, since very short texts teach little."""
    return F.when(size >= 64, F.lit(2.0)).otherwise(F.lit(1.0))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per source (``source``, ``source_size``).

    Sources in code point order, null last, have the weights in turn. ``share`` of all words is given out by weight; a
    target stops at ``cap`` times the source's size and the excess goes to the others by weight. The level (words
    per unit of weight) at which everything is given out is found in closed form: with sources ordered by the
    level at which they are full, it is the largest of the levels that would not fill the next source.
    """
    everything = Window.partitionBy(F.lit(1))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_fill = everything.orderBy("_full", F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    before = F.coalesce(F.sum("_cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    return (
        sizes.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
        .withColumn("_cap", F.col("source_size") * cap)
        .withColumn("_full", F.col("_cap") / F.col("weight"))
        .withColumn("_level", (F.sum("source_size").over(everything) * F.lit(float(share)) - before) / open_weight)
        .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_full"), F.col("_level"))).over(everything))
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("weight")))
        .withColumn("target", F.coalesce("target", F.col("_cap").cast("double")))
        .drop("_cap", "_full", "_level")
    )


def named(docs: DataFrame, doc_id: str, text: str, source: str, into: Sequence[str]) -> DataFrame:
    """``docs`` with three columns named by ``into``: key of the source, size, name of the row (its id, or a hash of its text)."""
    key, size, name = into
    return (
        docs.withColumn(key, F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")))
        .withColumn(size, word_count(text))
        .withColumn(name, F.coalesce(F.col(doc_id).cast("string"), text_hash(text)))
    )


def text_hash(text: str = "text") -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def repeated_names(rows: DataFrame, name: str) -> DataFrame:
    return cut(rows.groupBy(name).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select(name))


def own_names(rows: DataFrame, name: str, alike: str, key: str) -> DataFrame:
    """Rows of repeated names with names of their own: the name, what tells the rows apart, and a number among rows alike."""
    place = fresh(rows, "_place")[0]
    numbered = occurrences(rows, [name, alike, key], place)
    return numbered.withColumn(name, F.concat(name, F.lit(":"), alike, F.lit(":"), key, F.lit("#"), place)).drop(place)


def ranked(rows: DataFrame, preference, seed: str, size: str, name: str, into: Sequence[str]) -> DataFrame:
    """``rows`` with two columns named by ``into``: rank in (0, 1) and its bin."""
    z, bin_ = into
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13), 16, 10).cast("long")
    u = (bits + 0.5) / F.lit(float(2**52))
    return (
        rows.withColumn(z, u / (1 - u) / preference(F.col(size)))
        .withColumn(z, F.col(z) / (1 + F.col(z)))
        .withColumn(bin_, F.least(F.floor(F.col(z) * BINS), F.lit(BINS - 1)).cast("int"))
    )


RANK = ("_key", "size", "_z", "_bin")


def sampling_plan(slim: DataFrame, weights: Sequence[int], share: float, cap: int) -> DataFrame:
    """One row per source: target, whole copies, and which ranks get one copy more. ``slim`` is a cut table of source and RANK."""
    bins = cut(slim.groupBy("_key", "source", "_bin").agg(F.sum("size").alias("_words")))
    sources = source_targets(
        bins.groupBy("_key", "source").agg(F.sum("_words").alias("source_size")), weights, share, cap
    )
    sources = sources.withColumn(
        "_base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    ).withColumn("_need", F.col("target") - F.col("_base") * F.col("source_size"))
    sources = cut(sources.drop("weight", "source"))

    run = Window.partitionBy("_key").orderBy("_bin")
    crossing = (
        bins.select("_key", "_bin", "_words", (F.sum("_words").over(run) - F.col("_words")).alias("_before"))
        .join(small(sources), "_key")
        .where((F.col("_before") <= F.col("_need")) & (F.col("_before") + F.col("_words") > F.col("_need")))
        .select("_key", F.col("_bin").alias("_edge"), "_before", "_need")
    )
    crossing = cut(crossing)
    inside = slim.join(small(crossing), "_key").where(F.col("_bin") == F.col("_edge"))
    upto = F.sum("size").over(Window.partitionBy("_key").orderBy("_z")) + F.col("_before")
    fits = (
        inside.withColumn("_upto", upto)
        .where(F.col("_upto") <= F.col("_need"))
        .groupBy("_key")
        .agg(F.max("_z").alias("_last"), F.max("_upto").alias("_filled"))
    )
    plan = cut(
        sources.join(crossing.drop("_need"), "_key", "left")
        .join(fits, "_key", "left")
        .withColumn("_gap", F.col("_need") - F.coalesce("_filled", "_before"))
    )
    off = F.abs(F.col("size") - F.col("_gap"))
    closing = (
        slim.join(small(plan), "_key")
        .where(~drawn_in() & (F.col("size") > 0) & (off < F.col("_gap")))
        .groupBy("_key")
        .agg(F.min(F.struct(off.alias("off"), F.col("_z").alias("z")))["z"].alias("_close"))
    )
    return cut(plan.join(closing, "_key", "left"))


def drawn_in(z: str = "_z", bin_: str = "_bin") -> Column:
    """Whether a rank is before the cut of its source's plan."""
    at_edge = (F.col(bin_) == F.col("_edge")) & F.coalesce(F.col(z) <= F.col("_last"), F.lit(False))
    return F.coalesce((F.col(bin_) < F.col("_edge")) | at_edge, F.lit(False))


def copies(size: str = "size", z: str = "_z", bin_: str = "_bin") -> Column:
    extra = drawn_in(z, bin_) | F.coalesce(F.col(z) == F.col("_close"), F.lit(False))
    return F.when(F.col(size) > 0, F.col("_base") + F.when(extra, 1).otherwise(0)).otherwise(F.lit(0)).cast("int")


def slim_ranks(rows: DataFrame, twice: DataFrame, preference, seed: str) -> DataFrame:
    """Cut rows of RANK and others; ``_row`` is the name that a row shares with others, null if it is alone with it."""
    alone = rows if twice.isEmpty() else rows.join(small(twice), "_name", "left_anti")
    found = alone.withColumn("_row", F.lit(None).cast("string"))
    if not twice.isEmpty():
        shared = rows.join(small(twice), "_name", "left_semi").withColumn("_row", F.col("_name"))
        found = found.unionByName(own_names(shared, "_name", "_alike", "_key").select(*found.columns))
    return cut(ranked(found, preference, seed, "size", "_name", ("_z", "_bin")))


def draw(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    preference=default_preference,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    Null texts and texts without words have size 0 and take nothing. A null source is a source of its own. Rows
    repeating a doc_id, or a text without one, have random numbers of their own and are drawn one by one. A sum that can't be met
    by whole documents ends at the last document that fits, plus the one further document whose
    size is closest to the gap, if that makes the gap smaller. An empty table gives no rows. Reruns agree: the random number
    is a function of seed and id, for repeated ids of text, source and number among rows alike, too. Other columns are not looked at.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"))
    rows = named(docs, "doc_id", "text", "source", ("_key", "size", "_name")).withColumn("_alike", text_hash())
    rows = cut(rows.select("doc_id", "source", "_key", "size", "_name", "_alike"))
    slim = slim_ranks(rows, repeated_names(rows, "_name"), preference, seed).drop("_name", "_alike", "_row")
    return (
        slim.join(small(sampling_plan(slim, weights, share, cap)), "_key")
        .withColumn("copies", copies())
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    preference=default_preference,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as ``draw`` takes it, with the columns they came with.

    Texts are not shuffled: a row's copies follow from its own rank and its source's line of the plan. Only where names repeat,
    one of the rows that agree in all columns is joined to the number of copies that these take, task by task.
    """
    hashable = [f.name for f in docs.schema if not f.dataType.simpleString().count("map<")]
    full = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").alias("_id"),
        F.col("text").alias("_text"),
        "source",
        F.hex(F.xxhash64(*hashable)).alias("_alike"),
    )
    full = named(full, "_id", "_text", "source", ("_key", "size", "_name"))
    rows = cut(full.select("source", "_key", "size", "_name", "_alike"))
    twice = repeated_names(rows, "_name")
    slim = slim_ranks(rows, twice, preference, seed)
    plan = small(sampling_plan(slim, weights, share, cap).select("_key", "_base", "_edge", "_last", "_close"))
    taken = F.explode(F.sequence(F.lit(1), F.col("_n")))
    alone = ranked(full.join(small(twice), "_name", "left_anti"), preference, seed, "size", "_name", ("_z", "_bin"))
    out = alone.join(plan, "_key").withColumn("_n", copies()).where("_n > 0").select("row", taken).select("row.*")
    if twice.isEmpty():
        return out
    theirs = slim.where("_row IS NOT NULL").join(plan, "_key").withColumn("_n", copies())
    theirs = theirs.groupBy("_row", "_alike", "_key", F.spark_partition_id().alias("_task")).agg(F.sum("_n").cast("int").alias("_n")).where("_n > 0")
    one = full.join(small(twice), "_name", "left_semi").groupBy("_name", "_alike", "_key").agg(F.first("row").alias("row"))
    again = one.withColumnRenamed("_name", "_row").join(theirs, ["_row", "_alike", "_key"]).select("row", taken).select("row.*")
    return out.unionByName(again)


def op10_pareto_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return draw(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP10_SQL = """
WITH d AS (
  SELECT doc_id, source, size, (CAST('0x' || substr(md5('mix-1:' || CASE WHEN count(*) OVER (PARTITION BY name) = 1 THEN name
           ELSE name || ':' || alike || ':' || coalesce('=' || source, '') || '#'
                || row_number() OVER (PARTITION BY name, alike, source ORDER BY size) END), 1, 13) AS BIGINT) + 0.5::DOUBLE)
         / 4503599627370496::DOUBLE AS u
  FROM (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
               md5(coalesce(text, '')) AS alike, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS name
        FROM documents)),
q AS (SELECT *, u / (1 - u) / CASE WHEN size >= 64 THEN 2::DOUBLE ELSE 1::DOUBLE END AS r FROM d),
z AS (SELECT doc_id, source, size, r / (1 + r) AS z FROM q),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM z GROUP BY source),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM s),
c AS (SELECT *, (source_size * 2)::DOUBLE / weight AS full_at, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total FROM w),
l AS (SELECT *, (total - coalesce(sum(source_size * 2) OVER (ORDER BY full_at, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
              / (sum(weight) OVER (ORDER BY full_at, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM c),
t AS (SELECT source, source_size, least((source_size * 2)::DOUBLE,
             (SELECT max(level) FROM l WHERE level <= full_at) * weight::DOUBLE) AS target FROM l),
n AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS base,
             target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS need FROM t),
o AS (SELECT z.*, n.source_size, n.target, n.base, n.need,
             (sum(z.size) OVER (PARTITION BY z.source ORDER BY z.z))::BIGINT AS upto
      FROM z JOIN n ON z.source IS NOT DISTINCT FROM n.source),
g AS (SELECT source, coalesce(max(upto) FILTER (upto <= need), 0) AS filled FROM o GROUP BY source),
k AS (SELECT o.source, min({'off': abs(size - (need - filled)), 'z': z}).z AS closing
      FROM o JOIN g ON o.source IS NOT DISTINCT FROM g.source
      WHERE upto > need AND size > 0 AND abs(size - (need - filled)) < need - filled GROUP BY o.source),
f AS (SELECT o.*, CASE WHEN size = 0 THEN 0 ELSE base + CASE WHEN upto <= need OR z = closing THEN 1 ELSE 0 END END AS copies
      FROM o LEFT JOIN k ON o.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies::INTEGER AS copies FROM f
"""
