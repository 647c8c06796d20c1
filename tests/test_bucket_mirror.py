from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest
from conftest import plan, same_rows
from pyspark.sql import functions as F
from test_mirror import at, held, rows

from bazaarlake.operators import bucket_mirror
from bazaarlake.operators.bucket_mirror import BucketMirror
from bazaarlake.operators.latest import latest_by_key
from bazaarlake.session import work_dir
from bazaarlake.sources.commits import CommitConflict, CommitLog


def fresh(spark, **options):
    return BucketMirror(spark, work_dir(spark, "buckets"), "t", **({"buckets": 8} | options))


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def bases(mirror):
    return {b: own["base"] for b, own in mirror.state()[1]["held"].items()}


def test_newest_wins_and_ties_go_to_the_last_batch(spark):
    mirror = fresh(spark)
    assert mirror.load(rows(spark, (1, at(1), "a"), (2, at(5), "a"), (3, at(5), "a"), (3, at(4), "older"))) == 4
    mirror.load(rows(spark, (1, at(6), "b"), (2, at(3), "b"), (3, at(5), "b")), lookback=timedelta(hours=1))
    assert held(mirror.current()) == {1: "b", 2: "a", 3: "b"}
    assert mirror.load(rows(spark, (1, at(6), "b"))) == 0
    log = mirror.checkpoint_log().orderBy("run_ts").collect()
    assert [r["rows_loaded"] for r in log] == [4, 3, 0] and [r["last_write_date"] for r in log] == [at(5), at(6), at(6)]


def test_buckets_are_merged_without_a_shuffle(spark):
    mirror = fresh(spark)
    mirror.load(rows(spark, *[(i, at(i % 9), "a") for i in range(500)]))
    mirror.load(rows(spark, *[(i, at(20), "b") for i in range(0, 500, 7)]))
    assert exchanges(mirror.current()) == 0 and exchanges(mirror.current(in_place=False)) == 1
    assert same_rows(mirror.current(), mirror.current(in_place=False))
    mirror.compact()
    mirror.load(rows(spark, (1, at(30), "c")))
    merged = mirror.current()
    assert exchanges(merged) == 0
    assert held(merged) == {i: "c" if i == 1 else "b" if i % 7 == 0 else "a" for i in range(500)}


def test_compaction_rewrites_touched_buckets_only(spark):
    mirror = fresh(spark)
    mirror.load(rows(spark, *[(i, at(1), "a") for i in range(200)]))
    assert mirror.compact() == 8 and mirror.compact() == 0
    before = bases(mirror)
    mirror.load(rows(spark, (5, at(2), "b"), (6, at(2), "b")))
    touched = {b for b, own in mirror.state()[1]["held"].items() if own["later"]}
    assert 1 <= len(touched) <= 2
    files = spark.read.parquet(mirror._data).select("_metadata.file_path").distinct().count()
    assert mirror.compact() == len(touched)
    assert spark.read.parquet(mirror._data).select("_metadata.file_path").distinct().count() == files + len(touched)
    after = bases(mirror)
    assert {b for b in after if after[b] != before[b]} == touched
    assert held(mirror.current()) == {i: "b" if i in (5, 6) else "a" for i in range(200)}
    assert mirror.vacuum(keep=1) > 0
    assert held(mirror.current()) == {i: "b" if i in (5, 6) else "a" for i in range(200)}


def test_the_number_of_buckets_is_fixed(spark):
    mirror = fresh(spark)
    mirror.load(rows(spark, (1, at(1), "a")))
    other = fresh_handle(mirror)
    other.buckets = 5
    with pytest.raises(ValueError, match="8 buckets"):
        other.current()


def test_older_versions_can_be_read(spark):
    mirror = fresh(spark)
    mirror.load(rows(spark, (1, at(1), "a")))
    version, _ = mirror.state()
    mirror.load(rows(spark, (1, at(2), "b")))
    mirror.compact()
    assert held(mirror.current(version)) == {1: "a"} and held(mirror.current()) == {1: "b"}


def test_a_bucket_may_be_cut_by_other_columns_than_the_key(spark):
    lines = spark.range(300).selectExpr("id", "id div 3 AS order_id", "timestamp'2026-01-01' AS write_date")
    orders = spark.range(100).selectExpr("id", "timestamp'2026-01-01' AS write_date", "concat('o', id) AS name")
    root = work_dir(spark, "joined")
    l = BucketMirror(spark, root, "lines", by=("order_id",), buckets=8)
    o = BucketMirror(spark, root, "orders", buckets=8)
    l.load(lines), o.load(orders)
    o.load(orders.where("id < 9").selectExpr("id", "write_date + interval 1 day AS write_date", "'new' AS name"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = l.current().join(o.current().select(F.col("id").alias("o_id"), "name"), F.col("order_id") == F.col("o_id"))
        assert "Exchange" not in plan(joined) and joined.where("name = 'new'").count() == 27 and joined.count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_far_larger_bucket_is_merged_by_a_shuffle(spark):
    mirror = fresh(spark, by=("v",))
    mirror.load(spark.range(20_000).selectExpr("id", "timestamp'2026-01-01' AS write_date", "if(id < 19000, 'hot', cast(id as string)) AS v"))
    mirror.load(spark.range(20_000, 20_010).selectExpr("id", "timestamp'2026-01-02' AS write_date", "'x' AS v"))
    assert not mirror.even(mirror.state()[1])
    assert exchanges(mirror.current()) == 1 and mirror.current().count() == 20_010


def test_two_loads_at_once(spark):
    """Whoever is overtaken starts again from the new mark: rows and run log agree, and nothing is doubled."""
    mirror = fresh(spark)
    source = rows(spark, *[(i, at(i % 50), "a") for i in range(100)])
    with ThreadPoolExecutor(4) as pool:
        loaded = list(pool.map(lambda _: fresh_handle(mirror).load(source), range(4)))
    assert sorted(loaded) == [0, 0, 0, 100]
    assert mirror.current().count() == 100
    stored = spark.read.parquet(*[mirror._folder(a, b) for a, b in mirror._parts(mirror.state()[1])])
    assert stored.count() == 100 == sum(r["rows_loaded"] for r in mirror.checkpoint_log().collect())


def fresh_handle(mirror):
    """Another writer's view of the same table."""
    other = BucketMirror(mirror.spark, "", mirror.table, buckets=mirror.buckets)
    other._root, other._data, other.commits = mirror._root, mirror._data, mirror.commits
    return other


def test_a_load_and_a_compaction_at_once(spark):
    mirror = fresh(spark)
    mirror.load(rows(spark, (1, at(1), "a"), (2, at(1), "a")))
    other, commit = fresh_handle(mirror), mirror.commits.commit
    calls = []

    def slow(number, content, note):
        if not calls:
            calls.append(other.compact())  # just before the load commits
        return commit(number, content, note)

    loader = fresh_handle(mirror)
    loader.commits = CommitLog(spark, mirror.commits.path)
    loader.commits.commit = slow
    loader.load(rows(spark, (1, at(2), "b")))
    assert calls[0] > 0 and held(mirror.current()) == {1: "b", 2: "a"}
    assert len([b for b in bases(mirror).values() if b]) == calls[0]


def test_a_number_goes_to_one_writer(spark):
    log = CommitLog(spark, work_dir(spark, "commits"))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: log.commit(1, {"i": i}), range(8)))
    assert sum(won) == 1 and log.read(1)["i"] == won.index(True) and log.numbers() == [1]
    assert not log.commit(1, {"i": 99}) and log.commit(2, {"i": 99}) and log.head()[0] == 2


def test_too_many_conflicts_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(bucket_mirror, "ATTEMPTS", 2)
    mirror, other = fresh(spark), None
    mirror.load(rows(spark, (1, at(1), "a")))
    other = fresh_handle(mirror)
    loader = fresh_handle(mirror)
    loader.commits = CommitLog(spark, mirror.commits.path)
    commit = loader.commits.commit
    minute = iter(range(10, 60))

    def overtaken(number, content, note):
        other.load(rows(spark, (2, at(next(minute)), "x")))
        return commit(number, content, note)

    loader.commits.commit = overtaken
    with pytest.raises(CommitConflict):
        loader.load(rows(spark, (1, at(5), "b")), lookback=timedelta(hours=2))
    assert held(mirror.current())[1] == "a"


def test_a_failed_load_leaves_nothing_visible(spark):
    mirror = fresh(spark)
    mirror.load(rows(spark, (1, at(1), "a")))
    with pytest.raises(Exception, match="no such moment"):
        mirror.load(rows(spark, (1, at(2), "b")).withColumn("v", F.raise_error(F.lit("no such moment")).cast("string")))
    assert held(mirror.current()) == {1: "a"} and mirror.checkpoint_log().count() == 1


def test_reconciliation_finds_deletions_and_silent_changes(spark):
    mirror = fresh(spark, buckets=4)
    data = [(i, at(i % 30), f"v{i}") for i in range(400)]
    mirror.load(rows(spark, *data))
    source = rows(spark, *[d for d in data if d[0] != 7 and d[0] != 8], (5, at(0), "silently older"), (900, at(1), "late"))
    source = source.where("NOT (id = 5 AND v = 'v5')")
    found = mirror.reconcile(source, ranges=50)
    assert found == {"ranges": 4, "rows": 4, "gone": 2}
    assert same_rows(mirror.current(), source)
    assert mirror.reconcile(source) == {"ranges": 0, "rows": 0, "gone": 0}
    mirror.load(rows(spark, (7, at(1, day=3), "back")))
    assert held(mirror.current())[7] == "back" and 8 not in held(mirror.current())
    mirror.compact()
    assert 8 not in held(mirror.current()) and held(mirror.current())[5] == "silently older"
    assert mirror.reconcile(rows(spark))["gone"] == 400 and mirror.current().count() == 0
    empty = fresh(spark)
    assert empty.reconcile(source)["rows"] == 399 and same_rows(empty.current(), source)


def test_the_current_rows_equal_a_recount_of_all_versions(spark):
    mirror, versions = fresh(spark, ties=("v",)), None
    for n in range(5):
        batch = spark.range(300).selectExpr(f"(id * 7 + {n}) % 90 AS id", f"timestamp_seconds(1000 * {n} + id % 40) AS write_date", f"concat('{n}-', id) AS v")
        mirror.load(batch, lookback=timedelta(hours=1))
        if n == 2:
            mirror.compact()
        batch = batch.withColumn("batch", F.lit(n))
        versions = batch if versions is None else versions.unionByName(batch)
    assert same_rows(mirror.current(), latest_by_key(versions, ["id"], ["write_date", "batch", "v"]).drop("batch"))


def test_a_lookup_opens_the_buckets_of_its_keys_only(spark):
    mirror = fresh(spark, buckets=16)
    mirror.load(rows(spark, *[(i, at(1), "a") for i in range(400)]))
    mirror.load(rows(spark, (5, at(2), "b")))
    found = mirror.lookup(5, 77, 1000)
    assert held(found) == {5: "b", 77: "a"}
    files = spark.read.parquet(mirror._data).select("_metadata.file_path").distinct().count()
    assert files == 17 and len(found.inputFiles()) <= 4
