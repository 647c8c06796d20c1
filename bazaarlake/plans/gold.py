"""Star schema: five dimensions and four facts built from mirrored tables.

Every builder takes ``silver``, a function from table name to a frame with one row per id. Columns the
warehouse declares non-null get '' or 0 where a left join finds nothing. A dimension below the planner's
broadcast threshold is broadcast; a larger one is merged on its key with hot keys spread (see ``skew_join``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.functions.calendar import date_key, day_name, iso_day_of_week, month_name
from bazaarlake.functions.money import difference, product, stored
from bazaarlake.functions.text import or_blank
from bazaarlake.operators.joins import skew_join

Silver = Callable[[str], DataFrame]

# Sort keys of the stored facts.
FACT_SORT = {
    "fact_sales": ("date_key", "customer_key", "sale_line_key"),
    "fact_payments": ("date_key", "customer_key", "payment_key"),
    "fact_purchases": ("date_key", "vendor_key", "purchase_line_key"),
    "fact_inventory": ("location_key", "product_key", "quant_key"),
}


def _cities(silver: Silver) -> DataFrame:
    return silver("cities").select(F.col("id").alias("_city"), F.col("name").alias("_city_name"))


def _governorates(silver: Silver) -> DataFrame:
    return silver("muhafazat").select(
        F.col("id").alias("_gov"),
        F.col("name").alias("_gov_name"),
        F.col("name_ar").alias("_gov_ar"),
        F.col("code").alias("_gov_code"),
    )


def _in_place(df: DataFrame, silver: Silver) -> DataFrame:
    """Add city and governorate."""
    df = skew_join(df, _cities(silver), [("city_id", "_city")], ["id"], "left")
    return skew_join(df, _governorates(silver), [("muhafaza_id", "_gov")], ["id"], "left")


def _partners(silver: Silver, role: str) -> DataFrame:
    partners = silver("res_partner").where(F.col("partner_type") == role)
    return _in_place(partners, silver)


def _city() -> Column:
    """The canonical city name, else the cleaned free text, else ''."""
    return F.coalesce(F.nullif(F.col("_city_name"), F.lit("")), F.col("city"), F.lit(""))


def dim_customer(silver: Silver) -> DataFrame:
    return _partners(silver, "customer").select(
        F.col("id").alias("customer_key"),
        F.col("name").alias("customer_name"),
        "email",
        "phone",
        "segment",
        "is_company",
        _city().alias("city"),
        or_blank(F.col("_gov_name")).alias("governorate"),
        or_blank(F.col("_gov_ar")).alias("governorate_ar"),
        or_blank(F.col("_gov_code")).alias("governorate_code"),
    )


def dim_vendor(silver: Silver) -> DataFrame:
    return _partners(silver, "vendor").select(
        F.col("id").alias("vendor_key"),
        F.col("name").alias("vendor_name"),
        "email",
        "phone",
        "is_company",
        _city().alias("city"),
        or_blank(F.col("_gov_name")).alias("governorate"),
        or_blank(F.col("_gov_ar")).alias("governorate_ar"),
        or_blank(F.col("_gov_code")).alias("governorate_code"),
    )


def category_parent(silver: Silver) -> DataFrame:
    """Each category with its parent's name, '' for a top category."""
    node = silver("product_category")
    parent = node.select(F.col("id").alias("_parent"), F.col("name").alias("_parent_name"))
    return node.join(parent, F.col("parent_id") == F.col("_parent"), "left").select(
        F.col("id").alias("category_id"),
        F.col("name").alias("category_name"),
        F.col("complete_name").alias("category_path"),
        or_blank(F.col("_parent_name")).alias("parent_category"),
    )


def dim_product(silver: Silver) -> DataFrame:
    template = silver("product_template").select(
        F.col("id").alias("_tmpl"),
        F.col("name").alias("_tmpl_name"),
        "type",
        "categ_id",
        "list_price",
        "standard_price",
    )
    zero = F.lit(0)
    variants = skew_join(silver("product_product"), template, [("product_tmpl_id", "_tmpl")], ["id"], "left")
    node = silver("product_category")
    return (
        skew_join(variants, category_parent(silver), [("categ_id", "category_id")], ["id"], "left", joined_from=[node, node])
        .select(
            F.col("id").alias("product_key"),
            F.col("default_code").alias("variant_code"),
            "barcode",
            F.col("name").alias("variant_name"),
            "color",
            "size",
            F.coalesce("_tmpl", zero.cast("bigint")).alias("template_id"),
            or_blank(F.col("_tmpl_name")).alias("template_name"),
            or_blank(F.col("type")).alias("product_type"),
            stored(F.coalesce("list_price", zero)).alias("list_price"),
            stored(F.coalesce("standard_price", zero)).alias("standard_price"),
            stored(F.coalesce("list_price", zero) + F.col("price_extra")).alias("variant_list_price"),
            or_blank(F.col("category_name")).alias("category_name"),
            or_blank(F.col("category_path")).alias("category_path"),
            or_blank(F.col("parent_category")).alias("parent_category"),
        )
    )


def dim_location(silver: Silver) -> DataFrame:
    return _in_place(silver("stock_location"), silver).select(
        F.col("id").alias("location_key"),
        F.col("code").alias("location_code"),
        F.col("name").alias("location_name"),
        "location_type",
        or_blank(F.col("_city_name")).alias("city"),
        or_blank(F.col("_gov_name")).alias("governorate"),
        or_blank(F.col("_gov_ar")).alias("governorate_ar"),
    )


def calendar_days(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.expr(f"sequence(date'{first}', date'{last}')")).alias("date"))


def dim_date(
    spark: SparkSession, first: str = "2015-01-01", last: str = "2035-12-31", weekend: tuple[int, ...] = (5, 6)
) -> DataFrame:
    """Calendar with a Friday/Saturday weekend (ISO days 5 and 6)."""
    d = F.col("date")
    return calendar_days(spark, first, last).select(
        date_key(d).alias("date_key"),
        d,
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        iso_day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        month_name(d).alias("month_name"),
        iso_day_of_week(d).isin(*weekend).cast("int").alias("is_weekend"),
    )


def lines_with_header(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Each line with its header's columns, prefixed ``h_``. An order with very many lines is spread."""
    head = headers.select(*[F.col(c).alias(f"h_{c}") for c in headers.columns])
    return skew_join(lines, head, [("order_id", "h_id")], ["id"])


def fact_sales(silver: Silver) -> DataFrame:
    joined = lines_with_header(
        silver("sale_order_line"),
        silver("sale_order").select("id", "name", "date_order", "partner_id", "location_id", "state"),
    )
    return joined.select(
        F.col("id").alias("sale_line_key"),
        F.col("h_id").alias("order_id"),
        F.col("h_name").alias("order_name"),
        date_key(F.col("h_date_order")).alias("date_key"),
        F.col("h_partner_id").alias("customer_key"),
        F.col("product_id").alias("product_key"),
        F.col("h_location_id").alias("location_key"),
        F.col("h_state").alias("order_state"),
        F.col("product_uom_qty").alias("quantity"),
        F.col("price_unit").alias("unit_price"),
        F.col("discount").alias("discount_pct"),
        F.col("price_subtotal").alias("amount_untaxed"),
        difference(F.col("price_total"), F.col("price_subtotal")).alias("tax_amount"),
        F.col("price_total").alias("amount_total"),
    )


def fact_payments(silver: Silver) -> DataFrame:
    return silver("account_payment").select(
        F.col("id").alias("payment_key"),
        F.col("name").alias("payment_name"),
        F.col("sale_order_id").alias("order_id"),
        F.col("partner_id").alias("customer_key"),
        date_key(F.coalesce("payment_date", "create_date")).alias("date_key"),
        "amount",
        "payment_type",
        "journal",
        "payment_method",
        F.col("state").alias("payment_state"),
    )


def fact_purchases(silver: Silver) -> DataFrame:
    joined = lines_with_header(
        silver("purchase_order_line"),
        silver("purchase_order").select("id", "name", "date_order", "partner_id", "location_id", "state"),
    )
    return joined.select(
        F.col("id").alias("purchase_line_key"),
        F.col("h_id").alias("order_id"),
        F.col("h_name").alias("order_name"),
        date_key(F.col("h_date_order")).alias("date_key"),
        F.col("h_partner_id").alias("vendor_key"),
        F.col("product_id").alias("product_key"),
        F.col("h_location_id").alias("location_key"),
        F.col("h_state").alias("order_state"),
        F.col("product_qty").alias("quantity"),
        F.col("price_unit").alias("unit_cost"),
        F.col("price_subtotal").alias("amount_untaxed"),
        difference(F.col("price_total"), F.col("price_subtotal")).alias("tax_amount"),
        F.col("price_total").alias("amount_total"),
    )


def fact_inventory(silver: Silver) -> DataFrame:
    """Stock lots valued at the template's cost; 0 where the variant or template is missing."""
    template = silver("product_template").select(F.col("id").alias("_tmpl"), F.col("standard_price").alias("_cost"))
    variants = silver("product_product").select(F.col("id").alias("_variant"), "product_tmpl_id")
    cost = skew_join(variants, template, [("product_tmpl_id", "_tmpl")], ["_variant"], "left").select("_variant", "_cost")
    lots = skew_join(
        silver("stock_quant"), cost, [("product_id", "_variant")], ["id"], "left", joined_from=[variants, template]
    )
    return lots.select(
        F.col("id").alias("quant_key"),
        F.col("product_id").alias("product_key"),
        F.col("location_id").alias("location_key"),
        F.col("quantity").alias("on_hand_qty"),
        F.col("reserved_quantity").alias("reserved_qty"),
        difference(F.col("quantity"), F.col("reserved_quantity")).alias("available_qty"),
        product(F.col("quantity"), F.coalesce("_cost", F.lit(0).cast("decimal(18,4)"))).alias("inventory_value"),
    )
