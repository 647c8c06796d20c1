"""Star-schema questions on the gold tables.

Facts are summed on their foreign key before they meet a dimension, so a customer, product or date with a
large share of the rows is reduced by partial sums on the map side and the joins are one row to one row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.plans import gold
from bazaarlake.plans.gold import Silver


def _sum(c: str, scale: int = 4):
    return F.sum(c).cast(f"decimal(24,{scale})")


def customer_amounts() -> list[Column]:
    return [_sum("amount_untaxed").alias("net"), _sum("amount_total").alias("total")]


def customer_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_key").agg(F.count(F.lit(1)).alias("lines"), *customer_amounts())


def customer_payments(payments: DataFrame) -> DataFrame:
    return payments.groupBy("customer_key").agg(_sum("amount").alias("paid"))


def kpi_sales_by_governorate(silver: Silver) -> DataFrame:
    """Sales and payments per governorate and city of the customer; '' for facts whose customer has no dimension row."""
    sales, paid = customer_sales(gold.fact_sales(silver)), customer_payments(gold.fact_payments(silver))
    return sales_by_governorate(sales, paid, gold.dim_customer(silver))


def sales_by_governorate(sales: DataFrame, paid: DataFrame, customers: DataFrame) -> DataFrame:
    """From sums per customer."""
    customers = customers.select("customer_key", "governorate", "city", F.lit(1).alias("known"))
    zero = F.lit(0).cast("decimal(24,4)")
    return (
        sales.join(paid, "customer_key", "full")
        .join(customers, "customer_key", "full")
        .groupBy(F.coalesce("governorate", F.lit("")).alias("governorate"), F.coalesce("city", F.lit("")).alias("city"))
        .agg(
            F.count("known").alias("customers"),
            F.coalesce(F.sum("lines"), F.lit(0)).alias("sale_lines"),
            F.coalesce(_sum("net"), zero).alias("amount_untaxed"),
            F.coalesce(_sum("total"), zero).alias("amount_total"),
            F.coalesce(_sum("paid"), zero).alias("amount_paid"),
        )
    )


def kpi_open_balance(silver: Silver) -> DataFrame:
    """Per customer with open orders: ordered, paid and still owed, cancelled orders left out."""
    orders = silver("sale_order").where("state <> 'cancel'").select("id", "partner_id", "amount_total")
    paid = gold.fact_payments(silver).groupBy("order_id").agg(_sum("amount").alias("paid"))
    zero = F.lit(0).cast("decimal(24,4)")
    owed = orders.join(paid, F.col("id") == F.col("order_id"), "left").select(
        "partner_id", "amount_total", F.coalesce("paid", zero).alias("paid")
    )
    return (
        owed.groupBy(F.col("partner_id").alias("customer_key"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            _sum("amount_total").alias("ordered"),
            _sum("paid").alias("paid"),
        )
        .withColumn("open_balance", (F.col("ordered") - F.col("paid")).cast("decimal(24,4)"))
        .where("open_balance > 0")
    )


def kpi_inventory(silver: Silver) -> DataFrame:
    """Stock position as one row: on hand, available, reserved ratio, value at cost."""
    totals = gold.fact_inventory(silver).agg(
        F.count(F.lit(1)).alias("lots"),
        _sum("on_hand_qty").alias("on_hand"),
        _sum("reserved_qty").alias("reserved"),
        _sum("available_qty").alias("available"),
        _sum("inventory_value").alias("inventory_value"),
    )
    ratio = F.try_divide(F.col("reserved").cast("decimal(20,4)"), F.col("on_hand").cast("decimal(20,4)"))
    return totals.withColumn("reserved_ratio", F.round(ratio, 4).cast("decimal(9,4)"))


def kpi_stock_distribution(silver: Silver) -> DataFrame:
    """Stock by governorate, location and parent category; '' for lots whose product or location has no dimension row."""
    lots = gold.fact_inventory(silver).groupBy("location_key", "product_key").agg(
        _sum("on_hand_qty").alias("qty"), _sum("inventory_value").alias("value")
    )
    product = gold.dim_product(silver).select(
        "product_key",
        F.when(F.col("parent_category") == "", F.col("category_name")).otherwise(F.col("parent_category")).alias(
            "category"
        ),
    )
    place = gold.dim_location(silver).select("location_key", "location_code", "governorate")
    per_category = (
        lots.join(product, "product_key", "left")
        .groupBy("location_key", F.coalesce("category", F.lit("")).alias("category"))
        .agg(_sum("qty").alias("qty"), _sum("value").alias("value"))
    )
    return (
        per_category.join(place, "location_key", "left")
        .groupBy(
            F.coalesce("governorate", F.lit("")).alias("governorate"),
            F.coalesce("location_code", F.lit("")).alias("location_code"),
            "category",
        )
        .agg(_sum("qty").alias("on_hand"), _sum("value").alias("inventory_value"))
    )


def kpi_stock_levels(silver: Silver) -> DataFrame:
    """Stock by governorate, location and category with the totals of every level above, in one pass over the sums per category.

    ``level`` is the number of columns rolled up (3: everything); rolled-up columns are NULL.
    """
    lots = kpi_stock_distribution(silver)
    return lots.rollup("governorate", "location_code", "category").agg(
        (F.grouping("governorate") + F.grouping("location_code") + F.grouping("category")).cast("int").alias("level"),
        F.count(F.lit(1)).alias("groups"),
        _sum("on_hand").alias("on_hand"),
        _sum("inventory_value").alias("inventory_value"),
    )


def daily_amounts() -> list[Column]:
    return [
        F.sum(F.when(F.col("order_state") != "cancel", F.col("amount_total"))).cast("decimal(24,4)").alias("kept"),
        F.sum(F.when(F.col("order_state") == "cancel", F.col("amount_total"))).cast("decimal(24,4)").alias("lost"),
    ]


def daily_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("date_key").agg(F.count(F.lit(1)).alias("lines"), *daily_amounts())


def kpi_monthly_sales(calendar: DataFrame, silver: Silver) -> DataFrame:
    """Sales per calendar month, cancelled orders apart, with the part made on weekends.

    Days outside the calendar count in their month, without a month name and not as weekends.
    """
    return monthly_sales(calendar, daily_sales(gold.fact_sales(silver)))


def monthly_sales(calendar: DataFrame, daily: DataFrame) -> DataFrame:
    """From sums per day."""
    days = calendar.select("date_key", "year", "month", "month_name", "is_weekend")
    zero = F.lit(0).cast("decimal(24,4)")
    weekend = F.sum(F.when(F.col("is_weekend") == 1, F.col("kept"))).cast("decimal(24,4)")
    return (
        daily.join(days, "date_key", "left")
        .groupBy(
            F.coalesce("year", F.expr("date_key div 10000").cast("int")).alias("year"),
            F.coalesce("month", F.expr("date_key div 100 % 100").cast("int")).alias("month"),
            F.coalesce("month_name", F.lit("")).alias("month_name"),
        )
        .agg(
            F.sum("lines").alias("sale_lines"),
            F.coalesce(_sum("kept"), zero).alias("amount_total"),
            F.coalesce(_sum("lost"), zero).alias("cancelled_total"),
            F.coalesce(weekend, zero).alias("weekend_total"),
        )
    )


def years_of(fact: DataFrame) -> tuple[str, str]:
    """The first day of the first year and the last day of the last year of a fact's ``date_key``; this year if it has no rows."""
    found = fact.agg(*[(f(F.col("date_key")) / 10000).cast("int").alias(f.__name__) for f in (F.min, F.max)]).first()
    this = date.today().year
    return f"{found['min'] or this:04d}-01-01", f"{found['max'] or this:04d}-12-31"


def calendar_activity(calendar: DataFrame, fact: DataFrame) -> DataFrame:
    """Every calendar day with the fact rows dated on it, 0 included."""
    used = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("fact_rows"))
    return calendar.join(used, "date_key", "left").withColumn("fact_rows", F.coalesce("fact_rows", F.lit(0)))
