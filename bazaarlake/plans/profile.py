"""Profile queries over the source tables: counts, distributions, spans, coverage, top lists.

``tables`` is a function from table name to a source frame.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake import schema
from bazaarlake.operators.rollup import union_all

Tables = Callable[[str], DataFrame]


def row_counts(tables: Tables) -> DataFrame:
    counts = [
        tables(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in schema.TABLES
    ]
    return union_all(counts).orderBy("table_name")


def partner_counts(tables: Tables) -> DataFrame:
    role = F.col("partner_type")
    return tables("res_partner").agg(
        F.count_if(role == "customer").alias("customers"),
        F.count_if(role == "vendor").alias("vendors"),
        F.count_if("active").alias("active_partners"),
    )


def _fan_out(df: DataFrame, key: str, what: str) -> DataFrame:
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    average = F.sum("n").cast("decimal(20,0)") / F.count(F.lit(1)).cast("decimal(20,0)")
    return sizes.agg(
        F.min("n").alias(f"min_{what}"),
        F.round(average, 2).cast("decimal(18,2)").alias(f"avg_{what}"),
        F.max("n").alias(f"max_{what}"),
    )


def variants_per_template(tables: Tables) -> DataFrame:
    return _fan_out(tables("product_product"), "product_tmpl_id", "variants")


def vendors_per_product(tables: Tables) -> DataFrame:
    return _fan_out(tables("product_supplierinfo"), "product_id", "vendors")


def order_time_span(tables: Tables) -> DataFrame:
    first, last = F.min("date_order").cast("timestamp"), F.max("date_order").cast("timestamp")
    return tables("sale_order").agg(
        first.alias("earliest_order"),
        last.alias("latest_order"),
        F.expr("(unix_micros(cast(max(date_order) as timestamp)) - unix_micros(cast(min(date_order) as timestamp)))"
               " div 1000000").alias("span_seconds"),
    )


def with_share(groups: DataFrame, count: str = "row_count") -> DataFrame:
    """Percent of all rows to one decimal. The window runs over the few aggregated groups only."""
    total = F.sum(count).over(Window.partitionBy())
    pct = F.lit(Decimal(100)) * F.col(count).cast("decimal(20,0)") / total.cast("decimal(20,0)")
    return groups.withColumn("pct", F.round(pct, 1).cast("decimal(5,1)"))


def _state_dist(orders: DataFrame) -> DataFrame:
    groups = orders.groupBy("state").agg(F.count(F.lit(1)).alias("row_count"))
    return with_share(groups).orderBy(F.desc("row_count"), "state")


def sale_state_dist(tables: Tables) -> DataFrame:
    return _state_dist(tables("sale_order"))


def purchase_state_dist(tables: Tables) -> DataFrame:
    return _state_dist(tables("purchase_order"))


def paid_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.col("sale_order_id").alias("_order")).agg(
        F.sum("amount").cast("decimal(18,2)").alias("paid")
    )


def payment_status(paid, total):
    return (
        F.when(paid.isNull() | (paid == 0), "unpaid")
        .when(paid >= total - F.lit(Decimal("0.01")), "paid_full")
        .otherwise("partial")
    )


def payment_coverage(tables: Tables) -> DataFrame:
    """Orders by how far their payments, of any state, cover the total."""
    orders = tables("sale_order").select("id", "amount_total")
    status = orders.join(paid_per_order(tables("account_payment")), F.col("id") == F.col("_order"), "left").select(
        payment_status(F.col("paid"), F.col("amount_total")).alias("payment_status")
    )
    groups = status.groupBy("payment_status").agg(F.count(F.lit(1)).alias("row_count"))
    return with_share(groups).orderBy(F.desc("row_count"), "payment_status")


def top_governorates(tables: Tables, k: int = 10) -> DataFrame:
    """Governorates by customers; customers are counted per governorate before the join."""
    per_gov = (
        tables("res_partner")
        .where("partner_type = 'customer'")
        .groupBy("muhafaza_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    gov = tables("muhafazat").select(F.col("id").alias("_gov"), F.col("name").alias("governorate"))
    return (
        per_gov.join(gov, F.col("muhafaza_id") == F.col("_gov"))
        .groupBy("governorate")
        .agg(F.sum("n").alias("customers"))
        .orderBy(F.desc("customers"), "governorate")
        .limit(k)
    )


def inventory_position(tables: Tables) -> DataFrame:
    def total(c):
        return F.round(F.sum(c), 0).cast("decimal(18,0)")

    on_hand, reserved = F.col("quantity"), F.col("reserved_quantity")
    return tables("stock_quant").agg(
        F.count(F.lit(1)).alias("quant_rows"),
        total(on_hand).alias("total_on_hand"),
        total(reserved).alias("total_reserved"),
        total(on_hand - reserved).alias("total_available"),
    )


def quantity_by_product_and_place(tables: Tables) -> DataFrame:
    """Lots summed per (product, location): what is joined afterwards has one row per pair."""
    return (
        tables("stock_quant")
        .groupBy("product_id", "location_id")
        .agg(F.sum("quantity").cast("decimal(18,3)").alias("qty"))
    )


def inventory_value_top(tables: Tables, k: int = 5) -> DataFrame:
    cost = (
        tables("product_product")
        .select(F.col("id").alias("_variant"), "product_tmpl_id")
        .join(
            tables("product_template").select(F.col("id").alias("_tmpl"), "standard_price"),
            F.col("product_tmpl_id") == F.col("_tmpl"),
        )
        .select("_variant", "standard_price")
    )
    place = (
        tables("stock_location")
        .select(F.col("id").alias("_place"), "muhafaza_id")
        .join(
            tables("muhafazat").select(F.col("id").alias("_gov"), F.col("name").alias("governorate")),
            F.col("muhafaza_id") == F.col("_gov"),
        )
        .select("_place", "governorate")
    )
    value = F.sum(F.col("qty") * F.col("standard_price"))
    return (
        quantity_by_product_and_place(tables)
        .join(cost, F.col("product_id") == F.col("_variant"))
        .join(place, F.col("location_id") == F.col("_place"))
        .groupBy("governorate")
        .agg(F.round(value, 2).cast("decimal(18,2)").alias("inventory_value"))
        .orderBy(F.desc("inventory_value"), "governorate")
        .limit(k)
    )


def duplicate_emails(tables: Tables) -> DataFrame:
    """Partners with an e-mail minus distinct e-mails, ignoring case and blanks."""
    mail = F.lower(F.trim(F.col("email")))
    per_mail = tables("res_partner").where(F.col("email").isNotNull()).groupBy(mail.alias("m")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_mail.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("emails"),
        F.count(F.lit(1)).alias("distinct_emails"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_emails"),
    )
