from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan, same_rows
from pyspark.sql import functions as F

from bazaarlake.operators.mirror import Mirror
from bazaarlake.operators.latest import latest_by_key
from bazaarlake.session import work_dir
from bazaarlake.sources import storage
from bazaarlake.streaming import mirror_stream

DDL = "id bigint, write_date timestamp, v string"


def at(minute, day=1):
    return datetime(2026, 1, day, 0, minute)


def rows(spark, *data):
    return spark.createDataFrame(list(data), DDL)


def held(df):
    return {r["id"]: r["v"] for r in df.collect()}


@pytest.fixture
def mirror(spark):
    return Mirror(spark, work_dir(spark, "test"), "t")


def test_newer_wins_older_loses_equal_takes_the_last_loaded(spark, mirror):
    mirror.load(rows(spark, (1, at(1), "a"), (2, at(5), "a"), (3, at(5), "a")))
    late = timedelta(hours=1)
    mirror.load(rows(spark, (1, at(6), "b"), (2, at(3), "b"), (3, at(5), "b")), lookback=late)
    assert held(mirror.current()) == {1: "b", 2: "a", 3: "b"}


def test_only_changed_rows_are_loaded(spark, mirror):
    source = rows(spark, (1, at(1), "a"), (2, at(2), "a"))
    assert mirror.load(source) == 2
    assert mirror.load(source) == 0
    assert mirror.load(source.unionByName(rows(spark, (1, at(3), "b")))) == 1
    assert held(mirror.current()) == {1: "b", 2: "a"}


def test_empty_run_is_recorded_and_keeps_the_cursor(spark, mirror):
    assert mirror.load(rows(spark)) == 0
    mirror.load(rows(spark, (1, at(1), "a")))
    mirror.load(rows(spark, (1, at(1), "a")))
    log = mirror.checkpoint_log().select("last_write_date", "rows_loaded").orderBy("run_ts").collect()
    assert [r["rows_loaded"] for r in log] == [0, 1, 0]
    assert [r["last_write_date"] for r in log] == [datetime(1970, 1, 1), at(1), at(1)]


def test_microseconds_are_kept_in_the_cursor(spark, mirror):
    precise = datetime(2026, 1, 1, 0, 0, 0, 123456)
    source = rows(spark, (1, precise, "a"))
    mirror.load(source)
    assert mirror.load(source) == 0


def test_a_crash_before_the_checkpoint_repeats_the_batch(spark, mirror):
    batch = rows(spark, (1, at(1), "a"), (2, at(2), "a"))
    storage.append_batch(batch.where("id = 1"), mirror._log, 1)  # half a load, no run recorded
    mirror.load(batch)
    assert mirror.log().count() == 2
    assert held(mirror.current()) == {1: "a", 2: "a"}


def test_a_crash_after_the_commit_loses_nothing(spark, mirror, monkeypatch):
    monkeypatch.setattr(storage, "mark_committed", lambda spark, path: None)
    mirror.load(rows(spark, (1, at(1), "a")))
    monkeypatch.undo()
    assert held(mirror.current()) == {1: "a"}
    assert mirror.load(rows(spark, (1, at(1), "a"), (2, at(2), "b"))) == 1
    assert held(mirror.current()) == {1: "a", 2: "b"}


def test_two_loads_at_once_agree_with_the_run_log(spark, mirror):
    source = rows(spark, *[(i, at(i % 50), "a") for i in range(30)])
    with ThreadPoolExecutor(3) as pool:
        loaded = list(pool.map(lambda _: Mirror(spark, mirror._log.rpartition("/t/")[0], "t").load(source), range(3)))
    assert sorted(loaded) == [0, 0, 30] and mirror.log().count() == 30
    assert sorted(r["rows_loaded"] for r in mirror.checkpoint_log().collect()) == [0, 0, 30]


def test_late_commit_needs_the_lookback(spark, mirror):
    mirror.load(rows(spark, (1, at(30), "a")))
    late = rows(spark, (1, at(30), "a"), (2, at(20), "late"))
    assert mirror.load(late) == 0
    mirror.load(late, lookback=timedelta(minutes=15))
    assert held(mirror.current()) == {1: "a", 2: "late"}


def test_compaction_changes_nothing_and_keeps_ties(spark, mirror):
    mirror.load(rows(spark, (1, at(1), "a"), (2, at(2), "a"), (3, at(3), "a")))
    mirror.load(rows(spark, (1, at(4), "b")))
    before = held(mirror.current())
    mirror.compact()
    mirror.compact()
    assert held(mirror.current()) == before
    mirror.load(rows(spark, (1, at(4), "c"), (2, at(1), "old"), (4, at(9), "new")), lookback=timedelta(hours=1))
    assert held(mirror.current()) == {1: "c", 2: "a", 3: "a", 4: "new"}
    same = latest_by_key(mirror.log(), ["id"], ["write_date", "batch_id"]).drop("batch_id")
    assert same_rows(mirror.current(), same)
    mirror.compact()
    assert same_rows(mirror.current(), same)


def test_trimmed_log_still_gives_the_current_rows(spark, mirror):
    for n in range(1, 5):
        mirror.load(rows(spark, (n, at(n), "a"), (9, at(n), f"v{n}")))
        mirror.compact(trim_log=True)
    assert storage.numbered_children(spark, mirror._log, "batch_id") == [4]
    assert storage.numbered_children(spark, mirror._snapshots, "upto") == [3, 4]
    mirror.load(rows(spark, (9, at(8), "v8")))
    assert held(mirror.current()) == {1: "a", 2: "a", 3: "a", 4: "a", 9: "v8"}


def test_snapshot_is_not_shuffled_by_a_small_batch(spark, mirror):
    mirror.load(rows(spark, *[(i, at(1), "a") for i in range(50)]))
    mirror.compact()
    mirror.load(rows(spark, (1, at(4), "b")))
    text = plan(mirror.current())
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 3


def test_run_times_are_utc(spark, mirror):
    mirror.load(rows(spark, (1, at(1), "a")))
    got = mirror.checkpoint_log().first()["run_ts"]
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert abs((now - got).total_seconds()) < 3600


def test_stream_takes_each_landed_file_once(spark):
    root = work_dir(spark, "stream")
    landing = f"{root}/landing"

    def land(first, n, name):
        rows(spark, *[(i % 7, at(i), name) for i in range(first, first + n)]).coalesce(1).write.mode("append").parquet(landing)

    def pull():
        mirror_stream.pull_available(spark, landing, rows(spark).schema, lambda d: d, f"{root}/m", files_per_batch=1)
        return spark.read.parquet(f"{root}/m/log").count()

    land(0, 10, "first")
    assert pull() == 10
    land(10, 5, "second")
    assert pull() == 15
    assert pull() == 15
    got = mirror_stream.current(spark, f"{root}/m", ["id"], "write_date")
    both = [(i % 7, i, "first" if i < 10 else "second") for i in range(15)]
    assert held(got) == {k: max((m, v) for kk, m, v in both if kk == k)[1] for k in range(7)}


def test_publish_switches_only_after_commit(spark):
    root = work_dir(spark, "publish")
    storage.publish(spark.range(3), root)
    storage.publish(spark.range(5), root)
    assert storage.read_published(spark, root).count() == 5
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/version=3")
    assert storage.read_published(spark, root).count() == 5
    storage.publish(spark.range(7), root)
    storage.publish(spark.range(8), root)
    assert storage.numbered_children(spark, root, "version") == [3, 4]
    assert storage.read_published(spark, root).count() == 8
    with pytest.raises(FileNotFoundError):
        storage.read_published(spark, f"{root}/none")


def test_insert_if_absent_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "id int, v string")
    once = storage.insert_if_absent(old, new, ["id"])
    assert held(once) == {1: "a", 2: "c"} and once.count() == 2
    assert same_rows(storage.insert_if_absent(once, new, ["id"]), once)


def test_sorted_layout_splits_a_hot_date(spark):
    df = spark.range(20_000).select(F.expr("CASE WHEN id % 2 = 0 THEN 20260101 ELSE 20260101 + id % 25 END").alias("date_key"), "id")
    out = storage.sorted_layout(df, ["date_key", "id"], 8)
    parts = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min("date_key"), F.max("date_key")).collect()
    assert len(parts) == 8 and max(r["n"] for r in parts) < 5000
    root = work_dir(spark, "layout")
    storage.publish(out, root)
    assert same_rows(storage.read_published(spark, root), df)
