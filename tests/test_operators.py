"""Skew-aware operators against their plain counterparts, with a key holding a third or more of the rows."""

import itertools
from collections import Counter

import pytest
from conftest import plan, same_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlake.operators.joins import hot_keys, missing_parents, skew_join
from bazaarlake.operators.latest import latest_by_key, merge_on_read
from bazaarlake.operators.rollup import rollup_totals
from bazaarlake.operators.series import explode_series, number_within, random_subset, sample_k_per_group

# Makes keys hot at test size.
EAGER = dict(probe=2, rows_per_copy=100)


@pytest.fixture(scope="module")
def many(spark):
    """3000 rows: a half under key 7, a tenth without key, the rest spread over 100 keys."""
    return spark.range(3000).select(
        "id",
        F.expr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id % 100 END").cast("bigint").alias("k"),
    )


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(0, 90).select(F.col("id").alias("pk"), (F.col("id") * 10).alias("v"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("listed", [False, True])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(no_broadcast, many, one, how, listed):
    hot = hot_keys(many, ["k"], ["id"], **EAGER) if listed else None
    got = skew_join(many, one, [("k", "pk")], ["id"], how, hot=hot)
    assert same_rows(got, many.join(one, F.col("k") == F.col("pk"), how))


def test_skew_join_spreads_the_hot_key(no_broadcast, many, one):
    hot = hot_keys(many, ["k"], ["id"], **EAGER)
    found = hot.collect()
    assert [(r["_hot_k"]) for r in found] == [7]
    assert found[0]["_copies"] >= 10
    joined = skew_join(many, one, [("k", "pk")], ["id"], hot=hot)
    assert "SortMergeJoin [k" in plan(joined) and "_one_salt" in plan(joined)


def test_unlisted_hot_key_is_split_at_run_time(no_broadcast, spark, many, one):
    """Neither side is read to look for hot keys; the partition of a hot key is split by AQE."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {c: spark.conf.get(c) for c in small}
    try:
        for c, v in small.items():
            spark.conf.set(c, v)
        joined = skew_join(many, one, [("k", "pk")], ["id"], "left")
        joined.collect()
        text = plan(joined)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert "skew=true" in text and text.split("Initial Plan")[0].count("Range (0, 3000") == 1


def test_small_side_needs_no_salt(many, one):
    joined = skew_join(many, one, [("k", "pk")], ["id"], "left")
    assert "BroadcastHashJoin" in plan(joined) and "_salt" not in plan(joined)


def test_hot_keys_are_bounded_by_rows(spark):
    even = spark.range(10_000).select("id", (F.col("id") % 500).alias("k"))
    assert hot_keys(even, ["k"], ["id"], probe=1, rows_per_copy=21).count() == 0
    assert hot_keys(even, ["k"], ["id"], probe=1, rows_per_copy=20).count() == 500


def test_number_within_equals_row_number(many):
    df = many.withColumn("mix", F.pmod(F.col("id") * 7919, F.lit(10007)))
    got = number_within(df, ["k"], F.col("mix") % 16, ["mix", "id"], "pos", "size")
    w = Window.partitionBy("k")
    want = df.withColumns(
        {"pos": F.row_number().over(w.orderBy(F.col("mix") % 16, "mix", "id")), "size": F.count("*").over(w)}
    )
    keyed = lambda d: d.where("k IS NOT NULL").select("id", "k", "mix", F.col("pos").cast("int"), "size")
    assert same_rows(keyed(got), keyed(want))


@pytest.mark.parametrize("rows_per_copy, rows_per_piece", [(1_000_000, 1_000_000), (3, 1_000_000), (3, 2)])
def test_sample_takes_k_distinct_items_of_the_group(no_broadcast, spark, rows_per_copy, rows_per_piece):
    items = spark.range(1000).select(F.expr("CASE WHEN id < 700 THEN 0 ELSE id % 30 END").alias("g"), F.col("id").alias("item"))
    requests = spark.range(500).select(F.col("id").alias("r"), F.expr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 40 END").alias("g"))
    got = sample_k_per_group(
        requests, items, "g", k=F.expr("1 + r % 5"), start=F.expr("r * 31"),
        shuffle_key=F.expr("item * 7919 % 1009"), item_key="item", request_key="r",
        rows_per_copy=rows_per_copy, rows_per_piece=rows_per_piece,
    )
    assert got.groupBy("r", "item").count().where("count > 1").isEmpty()
    assert got.join(items, ["g", "item"], "left_anti").isEmpty()
    sizes = items.groupBy("g").agg(F.count("*").alias("m"))
    want = requests.join(sizes, "g").select("r", F.least(F.expr("1 + r % 5"), "m").alias("n"))
    assert same_rows(got.groupBy("r").agg(F.count("*").alias("n")), want)


def test_explode_series_of_none(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, None)], "id int, n int")
    got = explode_series(df, F.col("n"), "k").select("id", "k")
    assert sorted(tuple(r) for r in got.collect()) == [(2, 1), (3, 1), (3, 2)]


def test_latest_prunes_before_the_shuffle(spark, source):
    text = plan(latest_by_key(source.change_feed, ["id"], ["write_date", "event_id"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_merge_on_read_equals_latest(spark):
    rank = ["w", "batch_id"]
    log = spark.range(2000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 1 ELSE id % 300 END").alias("id"),
        F.expr("id * 37 % 50").alias("w"),
        F.expr("CASE WHEN id < 1500 THEN 1 ELSE 2 + id % 2 END").alias("batch_id"),
        F.col("id").alias("payload"),
    )
    log = log.groupBy("id", "w", "batch_id").agg(F.max("payload").alias("payload"))
    snapshot = latest_by_key(log.where("batch_id = 1"), ["id"], rank)
    got = merge_on_read(snapshot, log.where("batch_id > 1"), ["id"], rank)
    assert same_rows(got, latest_by_key(log, ["id"], rank))


def test_merge_on_read_keeps_null_keys_once(spark):
    rows = "id int, w int, batch_id int"
    snapshot = spark.createDataFrame([(None, 5, 1), (1, 5, 1), (2, 5, 1)], rows)
    changes = spark.createDataFrame([(None, 6, 2), (1, 4, 2), (2, 5, 2), (3, 1, 2)], rows)
    got = merge_on_read(snapshot, changes, ["id"], ["w", "batch_id"])
    assert {tuple(r) for r in got.collect()} == {(None, 6, 2), (1, 5, 1), (2, 5, 2), (3, 1, 2)} and got.count() == 4


def test_merge_on_read_prunes(spark, tmp_path):
    wide = spark.range(10).select("id", F.lit(1).alias("w"), F.lit(1).alias("batch_id"), F.lit("x").alias("unread"))
    wide.write.parquet(str(tmp_path / "snapshot"))
    snapshot = spark.read.parquet(str(tmp_path / "snapshot"))
    text = plan(merge_on_read(snapshot, wide.where("id < 3"), ["id"], ["w", "batch_id"]).select("id"))
    assert text.count("FileScan") == 2 and "unread" not in text


def test_missing_parents_counts_rows_not_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert [tuple(r) for r in missing_parents(child, "fk", parent).collect()] == [(9, 3)]


def test_rollup_keeps_headers_without_lines(spark):
    money = "decimal(14,2)"
    headers = spark.range(1, 4).select(
        "id", *[F.lit(5).cast(money).alias(c) for c in ("amount_untaxed", "amount_tax", "amount_total")]
    )
    lines = spark.createDataFrame([(1, 10, 11), (1, 20, 23), (2, 1, 2)], "order_id bigint, n int, t int").select(
        "order_id", F.col("n").cast(money).alias("price_subtotal"), F.col("t").cast(money).alias("price_total")
    )
    got = {r["id"]: tuple(int(r[c]) for c in ("amount_untaxed", "amount_tax", "amount_total")) for r in rollup_totals(headers, lines).collect()}
    assert got == {1: (30, 4, 34), 2: (1, 1, 2), 3: (5, 5, 5)}


def test_random_subsets_are_independent(spark):
    """All subsets are about equally likely, and pairs of items meet as often as chance says."""
    drawn = spark.range(30_000).select(random_subset(F.col("id") * 37 + 5, F.lit(2), F.lit(6)).alias("s"))
    pairs = drawn.select(F.array_sort("s").alias("s")).groupBy("s").count().collect()
    assert len(pairs) == 15 and all(len(set(r["s"])) == 2 and 0 <= r["s"][0] and r["s"][1] < 6 for r in pairs)
    assert all(abs(r["count"] - 2000) < 200 for r in pairs)
    whole = spark.range(50).select(random_subset(F.col("id"), F.lit(4), F.lit(4)).alias("s"), random_subset(F.col("id"), F.lit(0), F.lit(4)).alias("none"))
    assert all(sorted(r["s"]) == [0, 1, 2, 3] and r["none"] == [] for r in whole.collect())


def test_sampled_subsets_hold_different_items_of_the_group(spark):
    requests = spark.range(4000).selectExpr("id AS order_id", "id % 3 AS g")
    items = spark.range(60).selectExpr("id AS item", "id % 2 AS g")
    got = sample_k_per_group(
        requests, items, "g", k=F.lit(3), start=F.col("order_id"), shuffle_key=F.expr("(item * 7 + 3) % 101"), item_key="item", request_key="order_id", independent=True
    )
    sets = got.groupBy("order_id", "g").agg(F.collect_set("item").alias("s"), F.count("*").alias("n")).collect()
    assert len(sets) == sum(i % 3 < 2 for i in range(4000))
    assert all(r["n"] == len(r["s"]) == 3 and {x % 2 for x in r["s"]} == {r["g"]} for r in sets)
    pairs = Counter(p for r in sets for p in itertools.combinations(sorted(r["s"]), 2))
    assert len(pairs) == 2 * 30 * 29 // 2  # every pair of a group meets; neighbours on a ring would not
    mean = sum(pairs.values()) / len(pairs)
    assert max(pairs.values()) < 3 * mean
