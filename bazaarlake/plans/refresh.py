"""Full-refresh variant: conformed bronze tables, four cleaned-up entity tables, a simple sales fact.

``bronze`` is a function from table name to a conformed frame. Only active partners and products are kept,
absent text is stored as ''.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions.calendar import date_key, day_name, iso_day_of_week, month_name
from bazaarlake.functions.text import or_blank
from bazaarlake.operators.joins import skew_join
from bazaarlake.plans.gold import calendar_days, lines_with_header
from bazaarlake.sources.extract import conform

Bronze = Callable[[str], DataFrame]


def bronze_of(source) -> Bronze:
    return lambda table: conform(source.table(table), table)


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(F.col("id").alias(f"_{prefix}"), F.col("name").alias(f"_{prefix}_name"))


def _in_place(df: DataFrame, bronze: Bronze) -> DataFrame:
    """Add the names of city and governorate."""
    df = skew_join(df, _named(bronze("cities"), "city"), [("city_id", "_city")], ["id"], "left")
    return skew_join(df, _named(bronze("muhafazat"), "gov"), [("muhafaza_id", "_gov")], ["id"], "left")


def active_customers(bronze: Bronze) -> DataFrame:
    """All active partners, vendors included."""
    return (
        _in_place(bronze("res_partner").where("active"), bronze)
        .select(
            F.col("id").alias("customer_id"),
            F.col("name").alias("customer_name"),
            or_blank(F.col("email")).alias("email"),
            or_blank(F.col("phone")).alias("phone"),
            or_blank(F.col("street")).alias("street"),
            or_blank(F.col("_city_name")).alias("city_name"),
            or_blank(F.col("_gov_name")).alias("muhafaza_name"),
            "is_company",
            "partner_type",
            or_blank(F.col("segment")).alias("segment"),
            "active",
        )
    )


def active_products(bronze: Bronze) -> DataFrame:
    """Active variants with their template's name and list price (without the variant's extra)."""
    template = bronze("product_template").select(
        F.col("id").alias("_tmpl"), F.col("name").alias("_tmpl_name"), "categ_id", "list_price", "standard_price", "type"
    )
    zero = F.lit(0).cast("decimal(12,2)")
    variants = skew_join(
        bronze("product_product").where("active"), template, [("product_tmpl_id", "_tmpl")], ["id"], "left"
    )
    return (
        skew_join(variants, _named(bronze("product_category"), "cat"), [("categ_id", "_cat")], ["id"], "left")
        .select(
            F.col("id").alias("product_id"),
            or_blank(F.col("_tmpl_name")).alias("product_name"),
            or_blank(F.col("default_code")).alias("default_code"),
            or_blank(F.col("barcode")).alias("barcode"),
            or_blank(F.col("color")).alias("color"),
            or_blank(F.col("size")).alias("size"),
            or_blank(F.col("_cat_name")).alias("category_name"),
            F.coalesce("list_price", zero).alias("list_price"),
            F.coalesce("standard_price", zero).alias("standard_price"),
            or_blank(F.col("type")).alias("product_type"),
            "active",
        )
    )


def locations(bronze: Bronze) -> DataFrame:
    return (
        _in_place(bronze("stock_location"), bronze)
        .select(
            F.col("id").alias("location_id"),
            F.col("name").alias("location_name"),
            or_blank(F.col("code")).alias("location_code"),
            or_blank(F.col("location_type")).alias("location_type"),
            or_blank(F.col("_city_name")).alias("city_name"),
            or_blank(F.col("_gov_name")).alias("muhafaza_name"),
        )
    )


def sales(bronze: Bronze) -> DataFrame:
    joined = lines_with_header(
        bronze("sale_order_line"), bronze("sale_order").select("id", "partner_id", "location_id", "date_order", "state")
    )
    return joined.select(
        F.col("id").alias("sale_line_id"),
        F.col("h_id").alias("order_id"),
        F.col("h_partner_id").alias("customer_id"),
        F.col("h_location_id").alias("location_id"),
        F.col("h_date_order").alias("date_order"),
        F.col("h_state").alias("order_state"),
        "product_id",
        "product_uom_qty",
        "price_unit",
        "discount",
        "price_subtotal",
        "price_total",
    )


def fact_sales_simple(bronze: Bronze) -> DataFrame:
    return sales(bronze).select(
        "sale_line_id",
        "order_id",
        "customer_id",
        "product_id",
        "location_id",
        date_key(F.col("date_order")).alias("date_key"),
        "order_state",
        "product_uom_qty",
        "price_unit",
        "discount",
        "price_subtotal",
        "price_total",
    )


def dim_date_iso(
    spark: SparkSession, first: str = "2023-01-01", last: str = "2027-12-31", weekend: tuple[int, ...] = (6, 7)
) -> DataFrame:
    """Calendar with a Saturday/Sunday weekend."""
    d = F.col("date")
    return calendar_days(spark, first, last).select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        iso_day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        iso_day_of_week(d).isin(*weekend).alias("is_weekend"),
    )


def fact_dim_gap(bronze: Bronze) -> DataFrame:
    """Sales rows whose customer or product is missing from the active-only tables, per missing key.

    The sales are counted per key before the anti join, so a key with very many rows costs one row.
    """
    # Inner join keeps only lines that have an order; keys then come from either side.
    fact = sales(bronze)

    def gap(column: str, dim: DataFrame, label: str) -> DataFrame:
        used = fact.groupBy(F.col(column).alias("missing_key")).agg(F.count(F.lit(1)).alias("fact_rows"))
        known = dim.select(F.col(column).alias("missing_key"))
        return used.join(known, "missing_key", "left_anti").select(
            F.lit(label).alias("dimension"), "missing_key", "fact_rows"
        )

    return gap("customer_id", active_customers(bronze), "customers").unionByName(
        gap("product_id", active_products(bronze), "products")
    )
