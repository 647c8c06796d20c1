"""Star schema over the inferred raw layer, with the column names the source really has.

``raw`` is a function from table name to a loosely typed frame (see ``extract.raw_typed``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.text import or_blank
from bazaarlake.operators.joins import skew_join
from bazaarlake.plans.gold import lines_with_header
from bazaarlake.sources.extract import raw_typed

Raw = Callable[[str], DataFrame]


def raw_of(source) -> Raw:
    return lambda table: raw_typed(source.table(table))


def dim_customers_via_city(raw: Raw) -> DataFrame:
    """All partners; the governorate is the city's, so a partner without a city has none."""
    cities = raw("cities").select(
        F.col("id").alias("_city"), F.col("name").alias("city_name"), F.col("muhafaza_id").alias("_city_gov")
    )
    gov = raw("muhafazat").select(F.col("id").alias("_gov"), F.col("name").alias("governorate_name"))
    located = skew_join(
        raw("res_partner").select("id", "name", "email", "phone", "city_id"), cities, [("city_id", "_city")], ["id"], "left"
    )
    return skew_join(located, gov, [("_city_gov", "_gov")], ["id"], "left").select(
        F.col("id").alias("customer_id"),
        F.col("name").alias("customer_name"),
        "email",
        "phone",
        "city_name",
        "governorate_name",
    )


def dim_products_flat(raw: Raw) -> DataFrame:
    template = raw("product_template").select(
        F.col("id").alias("_tmpl"),
        F.col("name").alias("product_name"),
        "categ_id",
        F.col("list_price").alias("unit_price"),
        F.col("type").alias("product_type"),
    )
    category = raw("product_category").select(F.col("id").alias("_cat"), F.col("name").alias("category_name"))
    variants = skew_join(
        raw("product_product").select("id", "product_tmpl_id"), template, [("product_tmpl_id", "_tmpl")], ["id"], "left"
    )
    return skew_join(variants, category, [("categ_id", "_cat")], ["id"], "left").select(
        F.col("id").alias("product_id"), "product_name", "category_name", "unit_price", "product_type"
    )


def dim_locations_flat(raw: Raw) -> DataFrame:
    """The source has no location path; its code and name stand in for one."""
    return raw("stock_location").select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        F.concat_ws(" / ", "code", or_blank(F.col("name"))).alias("full_location_path"),
        "location_type",
    )


def fact_sales_flat(raw: Raw) -> DataFrame:
    joined = lines_with_header(
        raw("sale_order_line"), raw("sale_order").select("id", "partner_id", "location_id", "state", "date_order")
    )
    return joined.select(
        F.col("id").alias("line_id"),
        F.col("h_id").alias("order_id"),
        F.col("h_partner_id").alias("customer_id"),
        "product_id",
        F.col("h_location_id").alias("location_id"),
        F.col("product_uom_qty").alias("quantity"),
        "price_unit",
        F.col("price_subtotal").alias("subtotal_amount"),
        F.col("price_total").alias("total_amount"),
        F.col("h_state").alias("order_status"),
        F.col("h_date_order").alias("order_date"),
    )
