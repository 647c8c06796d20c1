import random

import pytest
from pyspark.sql import functions as F

from bazaarlake import schema
from bazaarlake.operators.key_bitmaps import KeyBitmaps, has_bit, key_bits
from bazaarlake.plans import quality
from bazaarlake.session import work_dir
from bazaarlake.sources import extract


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id bigint").repartition(3)


@pytest.fixture
def bitmaps(spark):
    return KeyBitmaps(spark, work_dir(spark, "bitmaps"))


def test_bits_are_the_keys(spark):
    rng = random.Random(1)
    held = {rng.randrange(-70_000, 70_000) for _ in range(500)} | {1, 32_768, 32_769, 10**15, -(10**15)}
    asked = [*held, *(x + 1 for x in held), *(x - 1 for x in held)]
    bits = key_bits(ids(spark, [*held, *held, None]), "id")
    found = ids(spark, asked).withColumn("b", F.bitmap_bucket_number("id")).join(bits, F.col("b") == F.col("bucket"), "left")
    for r in found.select("id", has_bit(F.col("bits"), F.bitmap_bit_position("id")).alias("has")).collect():
        assert r["has"] == (r["id"] in held)


def test_missing_parents_without_reading_them(spark, bitmaps):
    bitmaps.add("parent", 1, ids(spark, range(0, 100_000, 2)))
    bitmaps.add("parent", 2, ids(spark, [5, 7, None]))
    child = spark.createDataFrame([(2,), (3,), (3,), (5,), (None,), (10**12,)], "fk bigint")
    assert sorted(tuple(r) for r in bitmaps.missing(child, "fk", "parent").collect()) == [(3, 2), (10**12, 1)]
    bitmaps.fold("parent")
    assert sorted(tuple(r) for r in bitmaps.missing(child, "fk", "parent").collect()) == [(3, 2), (10**12, 1)]
    assert bitmaps.missing(child, "fk", "unknown").agg(F.sum("rows")).first()[0] == 5
    bitmaps.add("parent", 3, ids(spark, [3]))
    assert [tuple(r) for r in bitmaps.missing(child, "fk", "parent").collect()] == [(10**12, 1)]


def test_repeats_of_a_new_batch(spark, bitmaps):
    bitmaps.add("t", 1, ids(spark, range(1000)))
    bitmaps.add("t", 2, ids(spark, range(2000, 2100)))
    batch = ids(spark, [999, 1000, 1000, 1000, 2050, 2050, 50_000, None])
    assert tuple(bitmaps.repeats("t", 3, batch).first()) == (3, 2)
    assert tuple(bitmaps.repeats("t", 3, ids(spark, [])).first()) == (0, 0)
    assert tuple(bitmaps.repeats("new", 1, batch).first()) == (3, 0)


def test_the_check_finds_what_a_join_finds(spark, source, bitmaps):
    def broken(name):
        df = source.table(name)
        return df.where("id % 10 <> 4") if name in ("sale_order", "product_product") else df

    for parent in dict.fromkeys(p for _, _, p in schema.FOREIGN_KEYS):
        bitmaps.add(parent, 1, broken(parent))
    got = {tuple(r) for r in quality.fk_check_by_bitmaps(broken, bitmaps).collect()}
    assert got == {tuple(r) for r in quality.fk_check(broken).collect()} and sum(r[3] for r in got) > 0


def test_ranges_are_even_on_a_skewed_key(spark):
    df = spark.range(20_000).selectExpr("id", "pow(id, 3) AS far")
    wanted = extract.range_predicates(df, "far", 8)
    sizes = [df.where(p).count() for p in wanted]
    assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) <= 1.1 * min(sizes)
    hot = df.selectExpr("id", "if(id % 3 = 0, 5, if(id % 7 = 0, null, id)) AS k")
    wanted = extract.range_predicates(hot, "k", 5)
    read = extract.read_ranges(hot, wanted)
    assert read.count() == 20_000 == read.select("id").distinct().count()
    assert extract.range_predicates(df.where("false"), "far", 4) == ["1 = 1"] and extract.range_predicates(df, "far", 1) == ["1 = 1"]
