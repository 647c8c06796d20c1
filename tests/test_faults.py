"""Cases in which rows once went missing."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from bazaarlake import catalog
from bazaarlake.operators.mirror import Mirror
from bazaarlake.operators import mirror as mirror_module
from bazaarlake.plans import quality
from bazaarlake.session import SHUFFLE_PARTITIONS, build_session, work_dir
from bazaarlake.sources import storage


@pytest.fixture(scope="module")
def several_files(spark):
    """sf0.001 with the order lines in five files that hold them in the same order."""
    path = work_dir(spark, "several-files")
    for name in "region nation customer supplier part orders events".split():
        spark.read.parquet(f"{SF}/{name}.parquet").coalesce(1).write.parquet(f"{path}/{name}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines.repartitionByRange(5, "l_orderkey").write.parquet(f"{path}/lineitem.parquet")
    return path


LINE_QUERIES = ["fact_sales", "fact_purchases", "silver_sale_order_line", "silver_product_supplierinfo", "purchase_rollup", "order_rollup", "kpi_open_balance"]


@pytest.mark.parametrize("name", LINE_QUERIES)
def test_lines_of_several_files(spark, several_files, name):
    one, many = (catalog.QUERIES[name](spark, p).count() for p in (SF, several_files))
    assert many > 0
    if name in ("fact_sales", "fact_purchases", "silver_sale_order_line", "order_rollup"):
        assert many == one


def test_line_totals_of_several_files(spark, several_files):
    one, many = (catalog.QUERIES["fact_sales"](spark, p).agg(F.sum("amount_total")).first()[0] for p in (SF, several_files))
    assert one == many


def test_broadcast_off_gives_the_same_rows(spark):
    names = "fact_sales fact_purchases fact_inventory dim_customer dim_product sales fact_sales_flat kpi_sales_by_governorate fk_check".split()
    usual = {n: catalog.QUERIES[n](spark, SF).collect() for n in names}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, rows in usual.items():
            assert sorted(map(str, catalog.QUERIES[name](spark, SF).collect())) == sorted(map(str, rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_crash_compact_load(spark, monkeypatch):
    def rows(a, b, day):
        return spark.range(a, b).select("id", F.to_timestamp(F.lit(f"2024-01-{day:02}")).alias("write_date"))

    mirror = Mirror(spark, work_dir(spark, "crash"), "t")
    mirror.load(rows(0, 10, 1))
    mirror.compact()
    with monkeypatch.context() as m:
        real = storage.append_batch

        def crash(*args):
            real(*args)
            raise RuntimeError("lost after the batch was written")

        m.setattr(mirror_module.storage, "append_batch", crash)
        with pytest.raises(RuntimeError):
            mirror.load(rows(10, 20, 2))
    assert mirror.current().count() == 10
    mirror.compact(trim_log=True)
    mirror.load(rows(10, 30, 2))
    assert mirror.current().count() == 30
    mirror.compact(trim_log=True)
    assert mirror.current().count() == 30


def test_orphans_with_null_keys(spark, source):
    def tables(name):
        df = source.table(name)
        return df.withColumn("partner_id", F.when(F.col("id") % 10 != 0, F.col("partner_id"))) if name == "sale_order" else df

    nulls = tables("sale_order").where("partner_id IS NULL").count()
    found = {r["check_name"]: r["bad_rows"] for r in quality.orphan_check(tables).collect()}
    assert nulls and found["sale_orders_without_partner"] == nulls


def test_bronze_keeps_optional_nulls(spark, source):
    from bazaarlake.sources.extract import conform

    partners = source.table("res_partner").limit(1)
    row = conform(partners.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in partners.schema]), "res_partner").first()
    filled = {c: row[c] for c in row.asDict() if row[c] is not None}
    assert filled == {"name": "", "is_company": False, "active": False}


@pytest.mark.parametrize("name,column,fact,total", [("kpi_stock_distribution", "on_hand", "fact_inventory", "on_hand_qty"), ("kpi_sales_by_governorate", "amount_total", "fact_sales", "amount_total")])
def test_kpis_keep_facts_without_dimension(spark, source, name, column, fact, total):
    from bazaarlake.plans import gold, kpi
    from bazaarlake.plans.silver import Silver

    class Thinned(Silver):
        def __call__(self, table):
            df = super().__call__(table)
            return df.where("id % 10 <> 0") if table in ("product_product", "res_partner") else df

    silver = Thinned(source)
    whole = getattr(gold, fact)(silver).agg(F.sum(total)).first()[0]
    assert float(getattr(kpi, name)(silver).agg(F.sum(column)).first()[0]) == pytest.approx(float(whole))


def test_shuffle_width_is_set():
    import inspect

    assert int(SHUFFLE_PARTITIONS) >= 4096 and "SHUFFLE_PARTITIONS" in inspect.getsource(build_session)


def test_checks_read_each_table_once(spark, source):
    read = []

    def tables(name):
        read.append(name)
        return source.table(name)

    quality.unique_check(tables)
    assert len(read) == len(set(read))
    read.clear()
    quality.fk_check(tables)
    assert max(map(read.count, read)) <= 2  # as a child and as a parent


def test_checks_count_offending_rows(spark):
    frames = {
        "a": spark.createDataFrame([(1, 1, "x"), (1, 9, "x"), (2, 9, None), (3, None, None)], "id int, b_id int, code string"),
        "b": spark.createDataFrame([(1,), (2,)], "id bigint"),
    }
    assert [r["bad_rows"] for r in quality.fk_check(frames.get, (("a", "b_id", "b"),)).collect()] == [2]
    unique = quality.unique_check(frames.get, (("a", ("id",)), ("a", ("code",)), ("a", ("b_id", "code")), ("b", ("id",))))
    assert {(r["table_name"], r["key_columns"]): r["bad_rows"] for r in unique.collect()} == {
        ("a", "id"): 1, ("a", "code"): 1, ("a", "b_id, code"): 0, ("b", "id"): 0,
    }
