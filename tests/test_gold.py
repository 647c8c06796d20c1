"""Defaults of unmatched joins, grain, and invariants of the star schema."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import plan
from pyspark.sql import functions as F

from bazaarlake import schema
from bazaarlake.plans import flat, gold, quality, refresh
from bazaarlake.plans.silver import Silver, mirror_select

WHEN = datetime(2026, 1, 1)


class Tables:
    """Small hand-written source tables; columns not given are NULL."""

    def __init__(self, spark):
        self.spark = spark
        self.data = {}

    def put(self, table, *rows):
        cols = schema.columns(table)
        full = []
        for r in rows:
            r = {"create_date": WHEN, "write_date": WHEN, **r}
            full.append(tuple(Decimal(str(r[c.name])) if r.get(c.name) is not None and c.type.startswith("decimal") else r.get(c.name) for c in cols))
        self.data[table] = self.spark.createDataFrame(full, ", ".join(f"{c.name} {c.type}" for c in cols))
        return self

    def table(self, name):
        return self.data[name]


@pytest.fixture(scope="module")
def tables(spark):
    t = Tables(spark)
    t.put("muhafazat", dict(id=1, name="Cairo", name_ar="ar", code="EG-C"))
    t.put("cities", dict(id=5, muhafaza_id=1, name="Nasr City"))
    person = dict(name="mona ali", muhafaza_id=1, is_company=False, partner_type="customer", active=True)
    t.put(
        "res_partner",
        dict(person, id=1, city="NASR city ", city_id=5),
        dict(person, id=2, city="GIZA "),
        dict(person, id=3, active=False),
        dict(person, id=4, muhafaza_id=99),
        dict(person, id=9, partner_type="vendor", phone="02-12345678", city_id=5),
    )
    t.put(
        "product_category",
        dict(id=1, name="Top", complete_name="Top"),
        dict(id=2, name="Leaf", parent_id=1, complete_name="Top / Leaf"),
    )
    tmpl = dict(default_code="T", type="product", active=True, list_price=10, standard_price=6.5)
    t.put("product_template", dict(tmpl, id=1, name="A", categ_id=1), dict(tmpl, id=2, name="B", categ_id=2))
    variant = dict(default_code="P", name="v", price_extra=1.25, active=True)
    t.put(
        "product_product",
        dict(variant, id=1, product_tmpl_id=1),
        dict(variant, id=2, product_tmpl_id=2),
        dict(variant, id=3, product_tmpl_id=77),
    )
    t.put(
        "stock_location",
        dict(id=1, name="W", code="W1", location_type="warehouse", muhafaza_id=1, city_id=5),
        dict(id=2, name="T", code="T1", location_type="transit"),
    )
    t.put(
        "stock_quant",
        dict(id=1, product_id=1, location_id=1, quantity=10, reserved_quantity=3),
        dict(id=2, product_id=3, location_id=1, quantity=10, reserved_quantity=0),
        dict(id=3, product_id=88, location_id=2, quantity=4, reserved_quantity=0),
    )
    pay = dict(name="p", partner_id=1, sale_order_id=1, amount=1, payment_type="i", partner_type="customer", journal="b", payment_method="m", state="draft")
    t.put("account_payment", dict(pay, id=1), dict(pay, id=2, payment_date=datetime(2026, 2, 3, 23, 59, 59)))
    order = dict(name="S1", location_id=1, date_order=WHEN, state="sale", amount_untaxed=1, amount_tax=0, amount_total=1)
    t.put("sale_order", dict(order, id=1, partner_id=1), dict(order, id=2, partner_id=3))
    line = dict(product_uom_qty=1, price_unit=1, discount=0, price_subtotal=10, price_total=11.4)
    t.put(
        "sale_order_line",
        dict(line, id=1, order_id=1, product_id=1),
        dict(line, id=2, order_id=2, product_id=2),
        dict(line, id=3, order_id=44, product_id=2),
    )
    return t


def by(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


def test_customer_city_falls_back_in_three_steps(tables):
    got = by(gold.dim_customer(Silver(tables)), "customer_key", "city", "governorate")
    assert got == {1: ("Nasr City", "Cairo"), 2: ("giza", "Cairo"), 3: ("", "Cairo"), 4: ("", "")}


def test_vendor(tables):
    got = gold.dim_vendor(Silver(tables)).collect()
    assert [(r["vendor_key"], r["vendor_name"], r["phone"], r["city"]) for r in got] == [(9, "Mona Ali", None, "Nasr City")]


def test_product_defaults(tables):
    got = by(
        gold.dim_product(Silver(tables)), "product_key", "template_name", "category_path", "parent_category", "variant_list_price"
    )
    assert got == {
        1: ("A", "Top", "", Decimal("11.25")),
        2: ("B", "Top / Leaf", "Top", Decimal("11.25")),
        3: ("", "", "", Decimal("1.25")),
    }


def test_transit_place_has_no_city(tables):
    assert by(gold.dim_location(Silver(tables)), "location_key", "city", "governorate") == {1: ("Nasr City", "Cairo"), 2: ("", "")}


def test_payment_date_falls_back(tables):
    assert by(gold.fact_payments(Silver(tables)), "payment_key", "date_key") == {1: 20260101, 2: 20260203}


def test_inventory_without_variant_or_template_is_worth_nothing(tables):
    got = by(gold.fact_inventory(Silver(tables)), "quant_key", "available_qty", "inventory_value")
    assert got == {1: (Decimal(7), Decimal(65)), 2: (Decimal(10), Decimal(0)), 3: (Decimal(4), Decimal(0))}


def test_sales_keep_lines_with_an_order_only(tables):
    assert by(gold.fact_sales(Silver(tables)), "sale_line_key", "tax_amount") == {1: Decimal("1.4"), 2: Decimal("1.4")}


def test_cost_change_reaches_inventory(tables):
    silver = Silver(tables)
    dearer = silver("product_template").withColumn("standard_price", F.lit(7).cast("decimal(18,4)"))
    got = by(gold.fact_inventory(Silver(tables, product_template=dearer)), "quant_key", "inventory_value")
    assert got[1] == Decimal(70)


def test_full_refresh_blanks_and_gap(tables):
    bronze = refresh.bronze_of(tables)
    got = by(refresh.active_customers(bronze), "customer_id", "email", "segment", "city_name")
    assert got == {1: ("", "", "Nasr City"), 2: ("", "", ""), 4: ("", "", ""), 9: ("", "", "Nasr City")}
    assert [tuple(r) for r in refresh.fact_dim_gap(bronze).collect()] == [("customers", 3, 1)]


def test_flat_governorate_comes_through_the_city(tables):
    got = by(flat.dim_customers_via_city(flat.raw_of(tables)), "customer_id", "governorate_name")
    assert got == {1: "Cairo", 2: None, 3: None, 4: None, 9: "Cairo"}


def test_quality_finds_injected_faults(tables):
    keys = {(r["table_name"], r["column_name"]): r["bad_rows"] for r in quality.fk_check(
        tables.table,
        [("res_partner", "muhafaza_id", "muhafazat"), ("res_partner", "city_id", "cities"),
         ("product_product", "product_tmpl_id", "product_template"), ("sale_order_line", "order_id", "sale_order"),
         ("stock_quant", "product_id", "product_product")],
    ).collect()}
    assert list(keys.values()) == [1, 0, 1, 1, 1]
    unique = quality.unique_check(tables.table, [("product_product", ("default_code",)), ("product_product", ("barcode",))])
    assert [r["bad_rows"] for r in unique.collect()] == [2, 0]


def test_value_state_and_null_checks_count_faults(spark):
    t = Tables(spark)
    for name in schema.TABLES:
        t.put(name)
    t.put("sale_order_line", dict(id=1, product_uom_qty=0, price_unit=-1, discount=101), dict(id=2, discount=100))
    t.put("sale_order", dict(id=1, state="lost"), dict(id=2))
    values = by(quality.value_check(t.table).where("table_name = 'sale_order_line'"), "rule", "bad_rows")
    assert values == {"product_uom_qty": 1, "price_unit": 1, "discount": 1}
    assert by(quality.state_check(t.table).where("bad_rows > 0"), "table_name", "bad_rows") == {"sale_order": 1}
    nulls = by(quality.not_null_check(t.table).where("table_name = 'sale_order'"), "rule", "bad_rows")
    assert nulls["state"] == 1 and nulls["name"] == 2 and nulls["id"] == 0


def test_calendars(spark):
    egypt = by(gold.dim_date(spark), "date_key", "day_of_week", "is_weekend", "day_name", "month_name", "quarter")
    iso = by(refresh.dim_date_iso(spark), "date_key", "day_of_week", "is_weekend")
    assert len(egypt) == 7670 and len(iso) == 1826
    assert egypt[20261204] == (5, 1, "Friday", "December", 4)
    assert iso[20261204] == (5, False) and iso[20261205] == (6, True)


def test_star_invariants(spark, source):
    silver = Silver(source)
    fact = gold.fact_sales(silver)
    assert fact.count() == source.table("sale_order_line").count()
    assert fact.where("amount_untaxed + tax_amount <> amount_total").isEmpty()
    assert fact.join(gold.dim_customer(silver), "customer_key", "left_anti").isEmpty()
    assert fact.join(gold.dim_product(silver), "product_key", "left_anti").isEmpty()
    for dim in (gold.dim_customer, gold.dim_vendor, gold.dim_product, gold.dim_location):
        df = dim(silver)
        required = [c for c in df.columns if c not in ("email", "phone", "segment", "barcode", "color", "size")]
        assert df.where(" OR ".join(f"{c} IS NULL" for c in required)).isEmpty()


def test_mirror_types(source):
    for name in schema.TABLES:
        got = mirror_select(source.table(name), name).schema
        want = schema.struct(name, mirror=True)
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in want]


def test_order_amounts_are_not_computed_where_unused(source):
    header = source.table("sale_order").select("id", "state")
    assert "lineitem" not in plan(header)


def test_plans_stay_in_the_jvm_and_prune(spark, source):
    silver = Silver(source)
    text = plan(gold.fact_sales(silver).groupBy("date_key").agg(F.sum("amount_total")))
    assert "Python" not in text and "CartesianProduct" not in text
    assert "l_shipdate" not in text and "l_partkey" not in text
    incremental = plan(source.table("sale_order").where(F.col("write_date") > F.lit("1999-01-01").cast("timestamp_ntz")))
    assert "GreaterThan(o_orderdate" in incremental
