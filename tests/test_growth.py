"""What a task holds, and how often rows are joined, as the tables grow."""

from pyspark.sql import functions as F

from bazaarlake import catalog
from bazaarlake.plans import gold, quality


def test_mirrors_get_more_buckets_with_more_rows(spark, source, monkeypatch):
    monkeypatch.setattr(catalog, "ROWS_PER_BUCKET", 256, raising=False)
    house = catalog._sales_mirrors(source, "growth")
    lines = source.raw("lineitem").count()
    _, state = house.mirror("sale_order_line").state()
    sizes = [sum(n for *_, n in own["later"]) for own in state["held"].values()]
    assert sum(sizes) == lines and house.buckets >= lines / 256 and max(sizes) < 3 * 256
    events = source.raw("events").count()
    assert catalog._bucketed_feed(source, "growth-feed").buckets >= events / 256


def test_a_refresh_joins_orders_and_lines_once_per_state(spark, source, monkeypatch):
    house, built = catalog._sales_mirrors(source, "once"), []
    fact = gold.fact_sales
    monkeypatch.setattr(gold, "fact_sales", lambda silver: built.append(1) or fact(silver))
    house.kpis().refresh()
    assert len(built) == 2  # as of now and as of the last refresh


def test_unique_check_holds_a_group_per_block_of_serial_ids(spark, monkeypatch):
    ids = [*range(-130, 130), *[i << 40 for i in range(1, 9)], 2**63 - 1, -(2**63)]
    far = [-1, 63, 64, 1 << 40, 2**63 - 1, -(2**63), -(2**63)]
    rows = [(i, i % 3, f"t{i}") for i in ids + far] + [(None, 1, "x"), (7, None, "y")]
    rows += [(1 << 20, 1, "t5")]  # repeats a text
    frame = spark.createDataFrame(rows, "id bigint, part int, code string")
    keys = (("a", ("id",)), ("a", ("part",)), ("a", ("part", "id")), ("a", ("code",)), ("a", ("id", "code")))
    held, per_rule = [], quality._per_rule
    monkeypatch.setattr(quality, "_per_rule", lambda rules, found, labels: held.append(found) or per_rule(rules, found, labels))
    got = {r["key_columns"]: r["bad_rows"] for r in quality.unique_check({"a": frame}.get, keys).collect()}

    def repeated(*names):
        known = frame.dropna(subset=list(names))
        return known.count() - known.select(*names).distinct().count()

    assert got == {", ".join(k): repeated(*k) for _, k in keys} and got["id"] == len(far) + 1 and got["code"] == len(far) + 1
    serial = spark.range(100_000).withColumn("id", F.col("id").cast("int"))
    twice = quality.unique_check({"a": serial.unionByName(serial)}.get, (("a", ("id",)),))
    assert [r["bad_rows"] for r in twice.collect()] == [100_000]
    assert held[-1].count() <= 100_000 // 64 + 1
