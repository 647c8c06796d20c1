"""Builds of the star schema, KPI sums kept by deltas, and the stream into a bucketed mirror."""

from datetime import timedelta

import pytest
from conftest import plan, same_rows
from pyspark.sql import functions as F
from test_mirror import at, held, rows

from bazaarlake import lakehouse
from bazaarlake.lakehouse import Lakehouse
from bazaarlake.operators.bucket_mirror import BucketMirror
from bazaarlake.plans import gold, kpi
from bazaarlake.plans.silver import Silver, mirror_select
from bazaarlake.session import work_dir
from bazaarlake.sources import storage
from bazaarlake.sources.commits import CommitConflict
from bazaarlake.streaming import mirror_stream


class Tables:
    """A source with some tables replaced."""

    def __init__(self, source, **tables):
        self.source, self.tables = source, tables

    def table(self, name):
        return self.tables.get(name, self.source.table(name))


@pytest.fixture(scope="module")
def house(spark, source):
    made = Lakehouse(spark, work_dir(spark, "snapshots"), buckets=2)
    made.load_silver(source)
    made.build_gold()
    return made


def test_readers_keep_their_build(spark, source, house):
    first = house.snapshot()
    sales = first.gold("fact_sales").count()
    more = source.table("sale_order_line").withColumns({"id": F.col("id") + 10_000_000, "write_date": F.expr("write_date + interval 20 years")})
    house.load_silver(Tables(source, sale_order_line=more))
    assert house.gold("fact_sales").count() == first.gold("fact_sales").count() == sales
    house.build_gold()
    assert house.gold("fact_sales").count() == 2 * sales
    assert first.gold("fact_sales").count() == sales == first.silver("sale_order_line").count()
    assert house.snapshot(1).gold("fact_sales").count() == sales


def test_a_failed_build_changes_nothing(spark, house, monkeypatch):
    number, manifest = house.builds.head()

    def broken(silver):
        return gold.fact_payments(silver).withColumn("amount", F.raise_error(F.lit("broken table")).cast("decimal(18,4)"))

    broken.__name__ = "fact_payments"
    monkeypatch.setattr(lakehouse, "FACTS", (broken, gold.fact_inventory))
    with pytest.raises(Exception, match="broken table"):
        house.build_gold()
    assert house.builds.head() == (number, manifest)
    assert len(storage.subfolders(spark, f"{house.root}/gold/fact_inventory")) == len(storage.subfolders(spark, f"{house.root}/gold/dim_vendor"))


def test_a_build_reads_one_state_of_all_mirrors(spark, source, tmp_path):
    """Rows loaded while a build is running are in none of its tables."""
    house = Lakehouse(spark, str(tmp_path / "house"), buckets=2)
    house.load_silver(source)
    versions, write = [], lakehouse.storage.write_sorted

    def late(df, path, key):
        if not versions:
            more = source.table("account_payment").withColumns({"id": F.col("id") + 10_000_000, "write_date": F.expr("write_date + interval 20 years")})
            versions.append(house.mirror("account_payment").load(more, lambda d: mirror_select(d, "account_payment")))
        write(df, path, key)

    lakehouse.storage.write_sorted = late
    try:
        house.build_gold()
    finally:
        lakehouse.storage.write_sorted = write
    assert versions[0] > 0
    assert same_rows(house.gold("fact_payments"), gold.fact_payments(Silver(source)))
    assert same_rows(house.snapshot().silver("account_payment"), Silver(source)("account_payment"))


def test_old_builds_are_deleted(spark, house):
    house.build_gold(), house.build_gold()
    assert len(storage.subfolders(spark, f"{house.root}/gold/dim_vendor")) == 2


def test_lakehouse_reconciles(spark, source, house):
    fewer = Tables(source, res_partner=source.table("res_partner").where("id % 5 <> 2"))
    found = house.reconcile(fewer, ["res_partner", "cities"])
    gone = source.table("res_partner").where("id % 5 = 2").count()
    assert found["res_partner"]["gone"] == gone > 0 and found["cities"] == {"ranges": 0, "rows": 0, "gone": 0}
    assert same_rows(house.silver("res_partner"), mirror_select(fewer.table("res_partner"), "res_partner"))


def test_kpis_by_deltas_equal_a_recount(spark, source):
    house = Lakehouse(spark, work_dir(spark, "kpis"), buckets=4)
    select = {t: lambda df, t=t: mirror_select(df, t) for t in ("sale_order", "sale_order_line", "account_payment")}
    for t, s in select.items():
        house.mirror(t).load(source.table(t), s)
    kpis, calendar, customers = house.kpis(), gold.dim_date(spark, first="1995-01-01"), gold.dim_customer(Silver(source))

    def recounted():
        silver = Silver(source, **{t: house.silver(t) for t in select})
        assert same_rows(kpis.monthly_sales(calendar), kpi.kpi_monthly_sales(calendar, silver))
        assert same_rows(kpis.sales_by_governorate(customers), kpi.kpi_sales_by_governorate(silver))

    assert kpis.refresh()["orders"] > 0
    recounted()
    assert kpis.refresh() == {"orders": 0, "payments": 0}
    later, wide = F.expr("write_date + interval 1 day"), timedelta(days=20_000)
    order = source.table("sale_order").where("id IN (30, 31)")
    moved = order.withColumns({"partner_id": F.lit(999_999).cast("bigint"), "date_order": F.expr("date_order + interval 400 days"), "write_date": later})
    house.mirror("sale_order").load(moved, select["sale_order"], lookback=wide)
    assert kpis.refresh() == {"orders": 2, "payments": 0}
    recounted()
    lines = source.table("sale_order_line").where("id % 100 <> 3")
    house.mirror("sale_order_line").compact()
    house.mirror("sale_order_line").reconcile(lines, select["sale_order_line"])
    house.mirror("sale_order_line").compact()  # the deletions themselves are gone from the files
    paid = source.table("account_payment").where("id % 50 = 1").withColumns({"amount": F.lit(0).cast("decimal(14,2)"), "write_date": later})
    house.mirror("account_payment").load(paid, select["account_payment"], lookback=wide)
    assert kpis.refresh()["payments"] == paid.count()
    recounted()
    for t, s in select.items():
        house.mirror(t).reconcile(source.table(t).where("false"), s)
    kpis.refresh()
    assert kpis.sums("daily").isEmpty() and kpis.sums("customer_paid").isEmpty()


def test_partial_sums_are_folded(spark, monkeypatch):
    from bazaarlake.plans import delta_kpi

    monkeypatch.setattr(delta_kpi, "FOLD", 3)
    root = work_dir(spark, "fold")
    times = "timestamp'2026-01-01' AS create_date, timestamp'2026-01-01' + make_interval(0,0,0,{0}) AS write_date"
    mirrors = [BucketMirror(spark, root, t, by=by, buckets=2) for t, by in (("o", ()), ("l", ("order_id",)), ("p", ()))]
    kpis = delta_kpi.DeltaKpis(spark, f"{root}/kpi", *mirrors)
    with pytest.raises(ValueError, match="order_id"):
        delta_kpi.DeltaKpis(spark, f"{root}/kpi", mirrors[0], mirrors[0], mirrors[2])
    for n in range(4):
        money = f"cast({n + 1} as decimal(18,4))"
        mirrors[0].load(spark.sql(f"SELECT 1L id, 'S' name, 7L partner_id, 1 location_id, timestamp'2026-01-05' date_order, 'sale' state, {times.format(n)}"))
        line = f"SELECT 1L id, 1L order_id, 2L product_id, {money} product_uom_qty, {money} price_unit, {money} discount, {money} price_subtotal, {money} price_total"
        mirrors[1].load(spark.sql(f"{line}, {times.format(n)}"))
        pay = "'x' name, 1L sale_order_id, 7L partner_id, timestamp'2026-01-05' payment_date, 'in' payment_type, 'j' journal, 'm' payment_method, 's' state"
        mirrors[2].load(spark.sql(f"SELECT 1L id, {pay}, {money} amount, {times.format(n)}"))
        kpis.refresh()
        day = kpis.sums("daily").collect()
        assert [(r["date_key"], r["lines"], int(r["kept"])) for r in day] == [(20260105, 1, n + 1)]
    assert len(kpis.commits.head()[1]["sums"]["daily"]) == 2
    mirrors[0].load(spark.sql(f"SELECT 1L id, 'S' name, 7L partner_id, 1 location_id, timestamp'2026-01-05' date_order, 'cancel' state, {times.format(9)}"))
    kpis.commits.commit(kpis.commits.head()[0] + 1, kpis.commits.head()[1])  # someone else's
    head = kpis.commits.head
    monkeypatch.setattr(kpis.commits, "head", lambda: (head()[0] - 1, head()[1]))
    with pytest.raises(CommitConflict):
        kpis.refresh()
    monkeypatch.setattr(kpis.commits, "head", head)
    kpis.refresh()
    assert [int(r["lost"]) for r in kpis.sums("daily").collect()] == [4]


def test_a_fact_of_stored_buckets_needs_no_shuffle(spark, source):
    house = Lakehouse(spark, work_dir(spark, "joined"), buckets=4)
    for t in ("sale_order", "sale_order_line"):
        house.mirror(t).load(source.table(t), lambda df, t=t: mirror_select(df, t))
        house.mirror(t).load(source.table(t).where("id % 9 = 1"), lambda df, t=t: mirror_select(df, t), lookback=timedelta(days=20_000))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.fact_sales(house.silver)
        assert "Exchange" not in plan(fact) and "SortMergeJoin" in plan(fact)
        assert same_rows(fact, gold.fact_sales(Silver(source)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_stream_and_batches_share_a_mirror(spark):
    root = work_dir(spark, "stream")
    mirror = BucketMirror(spark, root, "t", buckets=2)

    def land(name, *data):
        rows(spark, *data).coalesce(1).write.mode("append").parquet(f"{root}/landing")

    def pull():
        mirror_stream.feed(spark, f"{root}/landing", rows(spark).schema, lambda d: d, mirror, f"{root}/stream", files_per_batch=1)

    land("a", (1, at(1), "a"), (2, at(1), "a"))
    land("b", (1, at(2), "b"))
    pull()
    assert held(mirror.current()) == {1: "b", 2: "a"} and mirror.checkpoint_log().count() == 2
    assert mirror.compact() > 0
    mirror.load(rows(spark, (3, at(9), "by batch")))
    land("c", (2, at(3), "c"))
    append, failed = mirror.append, []

    def dies_after_its_commit(batch, stream, epoch):
        append(batch, stream, epoch)
        if not failed:
            failed.append(epoch)
            raise RuntimeError("executor gone")

    mirror.append = dies_after_its_commit
    with pytest.raises(Exception, match="executor gone"):
        pull()
    loads = mirror.checkpoint_log().count()
    pull()  # the same micro-batch again
    assert mirror.checkpoint_log().count() == loads and mirror.state()[1]["streams"] == {"landing": failed[0]}
    assert held(mirror.current()) == {1: "b", 2: "c", 3: "by batch"}
