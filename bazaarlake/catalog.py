"""Every registered query: a function of (spark, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake import schema
from bazaarlake.functions import calendar, money, text
from bazaarlake.lakehouse import Lakehouse
from bazaarlake.operators import mirror as mirrors
from bazaarlake.operators.bucket_mirror import BucketMirror
from bazaarlake.operators.key_bitmaps import KeyBitmaps
from bazaarlake.operators.latest import latest_by_key
from bazaarlake.operators.rollup import rollup_totals
from bazaarlake.operators.series import explode_series, sample_k_per_group
from bazaarlake.plans import flat, gold, kpi, profile, quality, refresh
from bazaarlake.plans.delta_kpi import DeltaKpis
from bazaarlake.plans.silver import Silver, mirror_select
from bazaarlake.session import work_dir
from bazaarlake.sources import extract, seed, storage
from bazaarlake.sources.tables import RetailSource
from bazaarlake.streaming import mirror_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Buckets of the mirrors that registered queries make: a task each, so that there are more of them the more rows there are.
SALES_BUCKETS, ROWS_PER_BUCKET = 8, 1 << 19


def source_query(build: Callable[[RetailSource], DataFrame]) -> Callable[[RetailSource], DataFrame]:
    """Register a query by its function's name."""
    QUERIES[build.__name__] = lambda spark, path: build(RetailSource(spark, path))
    return build


def _register(name: str, build: Callable[[RetailSource], DataFrame]) -> None:
    QUERIES[name] = lambda spark, path: build(RetailSource(spark, path))


def _buckets(rows: int) -> int:
    return max(SALES_BUCKETS, -(-rows // ROWS_PER_BUCKET))


def _utc(text_: str) -> datetime:
    return datetime.fromisoformat(text_).replace(tzinfo=timezone.utc)


# -- mirror, bronze and raw tables ---------------------------------------------------------------------------

for _t in schema.TABLES:
    _register(f"silver_{_t}", lambda src, t=_t: Silver(src)(t))
for _t in schema.REFRESH_TABLES:
    _register(f"bronze_{_t}", lambda src, t=_t: refresh.bronze_of(src)(t))
    _register(f"raw_{_t}", lambda src, t=_t: flat.raw_of(src)(t))

# -- star schema and its variants ----------------------------------------------------------------------------

for _build in (
    gold.dim_customer,
    gold.dim_vendor,
    gold.category_parent,
    gold.dim_product,
    gold.dim_location,
    gold.fact_sales,
    gold.fact_payments,
    gold.fact_purchases,
    gold.fact_inventory,
    kpi.kpi_sales_by_governorate,
    kpi.kpi_open_balance,
    kpi.kpi_inventory,
    kpi.kpi_stock_distribution,
    kpi.kpi_stock_levels,
):
    _register(_build.__name__, lambda src, b=_build: b(Silver(src)))
for _build in (
    refresh.active_customers,
    refresh.active_products,
    refresh.locations,
    refresh.sales,
    refresh.fact_sales_simple,
    refresh.fact_dim_gap,
):
    _register(_build.__name__, lambda src, b=_build: b(refresh.bronze_of(src)))
for _build in (
    flat.dim_customers_via_city,
    flat.dim_products_flat,
    flat.dim_locations_flat,
    flat.fact_sales_flat,
):
    _register(_build.__name__, lambda src, b=_build: b(flat.raw_of(src)))
for _build in (
    profile.row_counts,
    profile.partner_counts,
    profile.variants_per_template,
    profile.vendors_per_product,
    profile.order_time_span,
    profile.sale_state_dist,
    profile.purchase_state_dist,
    profile.payment_coverage,
    profile.top_governorates,
    profile.inventory_position,
    profile.inventory_value_top,
    profile.duplicate_emails,
    quality.orphan_check,
    quality.fk_check,
    quality.unique_check,
    quality.value_check,
    quality.state_check,
    quality.not_null_check,
    quality.total_reconciliation,
    quality.dirtiness_sample,
):
    _register(_build.__name__, lambda src, b=_build: b(src.table))


@source_query
def fk_check_bitmaps(src):
    """The foreign key check against bitmaps of the parents' keys, stored in two batches each."""
    bitmaps = KeyBitmaps(src.spark, work_dir(src.spark, "bitmaps"))
    for parent in dict.fromkeys(p for _, _, p in schema.FOREIGN_KEYS):
        rows = src.table(parent)
        bitmaps.add(parent, 1, rows.where("id % 2 = 0"))
        bitmaps.add(parent, 2, rows.where("id % 2 <> 0"))
    return quality.fk_check_by_bitmaps(src.table, bitmaps)


@source_query
def kpi_monthly_sales(src):
    return kpi.kpi_monthly_sales(gold.dim_date(src.spark, first="1995-01-01"), Silver(src))


@source_query
def dim_date(src):
    """The calendar with the sales lines dated on each day. It begins after the test data ends, so the
    lines are moved by 20 years."""
    moved = gold.fact_sales(Silver(src)).select((F.col("date_key") + 200000).alias("date_key"))
    return kpi.calendar_activity(gold.dim_date(src.spark), moved)


@source_query
def dim_date_iso(src):
    """The calendar of the full-refresh variant with the payments dated on each day, moved by 25 years."""
    paid = Silver(src)("account_payment").select(
        calendar.date_key(F.coalesce("payment_date", "create_date") + F.expr("interval 25 years")).alias("date_key")
    )
    return kpi.calendar_activity(refresh.dim_date_iso(src.spark), paid)


@source_query
def dim_date_in_use(src):
    """The calendar from the first to the last day of the years that sales fall in, with the sales lines dated on each day."""
    sold = gold.fact_sales(Silver(src)).select("date_key")
    return kpi.calendar_activity(gold.dim_date(src.spark, *kpi.years_of(sold)), sold)


@source_query
def dim_date_iso_in_use(src):
    """The same of the full-refresh variant, with the payments of each day; none is left out."""
    paid = gold.fact_payments(Silver(src)).select("date_key")
    return kpi.calendar_activity(refresh.dim_date_iso(src.spark, *kpi.years_of(paid)), paid)


@source_query
def fact_sales_final(src):
    """The sales fact over a mirror log that holds corrections and a stale replay: newest version counts."""
    orders, lines = (Silver(src)(t) for t in ("sale_order", "sale_order_line"))
    later = F.expr("write_date + interval 1 day")
    orders_log = (
        orders.withColumn("batch_id", F.lit(1))
        .unionByName(
            orders.where("id % 10 = 3").withColumns(
                {"state": F.lit("cancel"), "write_date": later, "batch_id": F.lit(2)}
            )
        )
        .unionByName(
            orders.where("id % 10 = 4").withColumns(
                {"state": F.lit("stale"), "write_date": F.expr("write_date - interval 1 day"), "batch_id": F.lit(3)}
            )
        )
    )
    lines_log = lines.withColumn("batch_id", F.lit(1)).unionByName(
        lines.where("id % 10 = 5").withColumns(
            {"discount": F.lit(50).cast("decimal(9,4)"), "batch_id": F.lit(2)}
        )
    )
    order = ["write_date", "batch_id"]
    return gold.fact_sales(
        Silver(
            src,
            sale_order=latest_by_key(orders_log, ["id"], order).drop("batch_id"),
            sale_order_line=latest_by_key(lines_log, ["id"], order).drop("batch_id"),
        )
    )


# -- extracts and stored tables ------------------------------------------------------------------------------


@source_query
def extract_full(src):
    return extract.in_utc(src.table("account_payment"))


@source_query
def extract_inferred(src):
    """Types as the files declare them, loosened to the raw layer's."""
    return extract.raw_typed(src.raw("orders"))


@source_query
def extract_incremental(src):
    return extract.in_utc(extract.changed_since(src.change_feed, _utc("2024-01-15T12:00:00")))


@source_query
def extract_lookback(src):
    late = extract.changed_since(src.change_feed, _utc("2024-01-15T12:00:00"), lookback=timedelta(days=2))
    return extract.in_utc(late)


@source_query
def extract_ranges(src):
    """Orders read in ranges of a key that thins out towards its end; pieces are of about equal size all the same."""
    orders = src.raw("orders").selectExpr("o_orderkey", "o_orderkey * o_orderkey AS far", "o_custkey", "o_orderstatus")
    return extract.read_ranges(orders, extract.range_predicates(orders, "far", 6)).drop("piece")


@source_query
def raw_typed(src):
    return extract.raw_typed(src.table("stock_quant"))


@source_query
def bronze_conform(src):
    """Partners without their optional text, then conformed: required columns get their defaults."""
    holes = src.table("res_partner").withColumns(
        {c: F.expr(f"if(id % 6 = 0, null, {c})") for c in ("name", "muhafaza_id", "is_company", "partner_type")}
    )
    return extract.conform(holes, "res_partner")


@source_query
def fact_layout(src):
    """The sales fact written in storage order and read back."""
    fact = gold.fact_sales(Silver(src))
    root = work_dir(src.spark, "fact_layout")
    storage.publish(fact, root, sort_key=gold.FACT_SORT["fact_sales"])
    return storage.read_published(src.spark, root)


def _sales_mirrors(src: RetailSource, purpose: str) -> Lakehouse:
    """Mirrors of orders, lines and payments as they are."""
    root = work_dir(src.spark, purpose)
    src.store("sale_order", f"{root}/source/sale_order")
    house = Lakehouse(src.spark, root, buckets=_buckets(src.raw("lineitem").count()))
    for table in ("sale_order", "sale_order_line", "account_payment"):
        house.mirror(table).load(src.table(table), lambda df, t=table: mirror_select(df, t))
    return house


@source_query
def fact_sales_stored(src):
    """The sales fact of mirrors that hold orders and their lines in equal buckets: joined bucket by bucket."""
    return gold.fact_sales(_sales_mirrors(src, "fact_sales_stored").silver)


def _corrected_kpis(src: RetailSource, purpose: str) -> tuple[Lakehouse, DeltaKpis]:
    """KPI sums after a first refresh, a batch of corrections and a reconciliation that finds deleted lines."""
    house = _sales_mirrors(src, purpose)
    kpis = house.kpis()
    kpis.refresh()
    later = F.expr("write_date + interval 1 day")
    orders, lines, paid = (Silver(src)(t) for t in ("sale_order", "sale_order_line", "account_payment"))
    double = {c: (F.col(c) * 2).cast("decimal(18,4)") for c in ("price_subtotal", "price_total")}
    wide = timedelta(days=20_000)  # the corrections are dated with the orders, not with today
    house.mirror("sale_order").load(orders.where("id % 10 = 3").withColumns({"state": F.lit("cancel"), "write_date": later}), lookback=wide)
    lines = lines.where("id % 10 = 5").withColumns(double | {"write_date": later}).unionByName(lines.where("id % 10 <> 5"))
    house.mirror("sale_order_line").load(lines.where("id % 10 = 5"), lookback=wide)
    house.mirror("account_payment").load(
        paid.where("id % 10 = 7").withColumns({"amount": (F.col("amount") * 3).cast("decimal(18,4)"), "write_date": later}), lookback=wide
    )
    kpis.refresh()
    house.mirror("sale_order_line").compact()
    house.mirror("sale_order_line").reconcile(lines.where("id % 50 <> 11"))
    kpis.refresh()
    return house, kpis


@source_query
def kpi_monthly_sales_by_deltas(src):
    _, kpis = _corrected_kpis(src, "kpi-month")
    return kpis.monthly_sales(gold.dim_date(src.spark, first="1995-01-01"))


@source_query
def kpi_sales_by_governorate_by_deltas(src):
    _, kpis = _corrected_kpis(src, "kpi-place")
    return kpis.sales_by_governorate(gold.dim_customer(Silver(src)))


@source_query
def insert_if_absent(src):
    orders = src.order_headers.select("id", "name", "state")
    offered = orders.select("id", F.concat("name", F.lit("-new")).alias("name"), "state")
    return storage.insert_if_absent(orders.where("id % 3 <> 0"), offered, ["id"])


# Zones of the test data's governorates.
ZONES = [
    ("R-0", "south", "EGP"),
    ("R-1", "west", "USD"),
    ("R-2", "east", "EGP"),
    ("R-3", "north", "EUR"),
    ("R-9", "unused", "EGP"),
]


@source_query
def seed_dims(src):
    """Inline zone rows joined on the governorate code, with the partners living there."""
    zones = seed.literal_rows(src.spark, ZONES, "mcode string, zone string, currency string")
    people = src.table("res_partner").groupBy("muhafaza_id").agg(F.count(F.lit(1)).alias("partners"))
    return seed.with_governorate(zones, src.table("muhafazat")).join(people, "muhafaza_id", "left").select(
        "muhafaza_id", "zone", "currency", F.coalesce("partners", F.lit(0)).alias("partners")
    )


@source_query
def location_city_lookup(src):
    """Each partner's city id looked up by governorate and cleaned city name."""
    people = src.table("res_partner").select(
        F.col("id").alias("partner_id"), "muhafaza_id", text.clean_city(F.col("city")).alias("city_name")
    )
    cities = src.table("cities").withColumn("name", F.lower("name"))
    return seed.with_city(people, cities, "partner_id")


# -- mirror --------------------------------------------------------------------------------------------------

FEED = "user_events"
RUNS = ("2024-01-11T00:00:00", "2024-01-21T00:00:00", None, None)


def _feed_until(src: RetailSource, until: str | None) -> DataFrame:
    if until is None:
        return src.change_feed
    limit = extract.utc_literal(_utc(until), src.change_feed.schema["write_date"].dataType)
    return src.change_feed.where(F.col("write_date") < limit)


def _feed_mirror(src: RetailSource, purpose: str) -> mirrors.Mirror:
    return mirrors.Mirror(src.spark, work_dir(src.spark, purpose), FEED, ties=("event_id",))


def _daily_runs(src: RetailSource, purpose: str, runs=RUNS) -> mirrors.Mirror:
    mirror = _feed_mirror(src, purpose)
    for until in runs:
        mirror.load(_feed_until(src, until), extract.in_utc)
    return mirror


@source_query
def latest_by_key_query(src):
    return latest_by_key(extract.in_utc(src.change_feed), ["id"], ["write_date", "event_id"])


QUERIES["latest_by_key"] = QUERIES.pop("latest_by_key_query")


@source_query
def mirror_upsert(src):
    return _daily_runs(src, "upsert").current()


@source_query
def mirror_backfill(src):
    """The log after one first run: every version of every key."""
    return _daily_runs(src, "backfill", runs=(None,)).log().drop("batch_id")


@source_query
def mirror_replay(src):
    """The second run reads five days again; the repeats change nothing."""
    mirror = _feed_mirror(src, "replay")
    mirror.load(_feed_until(src, RUNS[0]), extract.in_utc)
    mirror.load(src.change_feed, extract.in_utc, lookback=timedelta(days=5))
    return mirror.current()


@source_query
def mirror_compact(src):
    """Compacted after the first run, later runs merged at read time."""
    mirror = _daily_runs(src, "compact", runs=RUNS[:1])
    mirror.compact()
    mirror.load(src.change_feed, extract.in_utc)
    return mirror.current()


def _bucketed_feed(src: RetailSource, purpose: str) -> BucketMirror:
    return BucketMirror(src.spark, work_dir(src.spark, purpose), FEED, ties=("event_id",), buckets=_buckets(src.raw("events").count()))


@source_query
def mirror_buckets(src):
    """Daily runs into key buckets: compacted after the second, the last ones merged bucket by bucket."""
    mirror = _bucketed_feed(src, "buckets")
    for n, until in enumerate(RUNS):
        mirror.load(_feed_until(src, until), extract.in_utc)
        if n == 1:
            mirror.compact()
    return mirror.current()


@source_query
def mirror_reconcile(src):
    """Users are gone from the source after a full load: reconciliation takes them out of the mirror."""
    mirror = _bucketed_feed(src, "reconcile")
    mirror.load(src.change_feed, extract.in_utc)
    now = latest_by_key(extract.in_utc(src.change_feed.where("id % 7 <> 3")), ["id"], ["write_date", "event_id"])
    mirror.reconcile(now)
    return mirror.current()


@source_query
def mirror_full_refresh(src):
    return mirrors.full_refresh(extract.in_utc(src.table("stock_quant")), work_dir(src.spark, "refresh"))


@source_query
def checkpoint_log(src):
    log = _daily_runs(src, "checkpoint_log").checkpoint_log()
    return log.select("table_name", "last_write_date", "rows_loaded")


@source_query
def checkpoint_read(src):
    return mirrors.high_water(_daily_runs(src, "checkpoint_read", runs=RUNS[:2]).checkpoint_log(), FEED)


@source_query
def batch_high_water(src):
    cursor = _utc("2024-01-15T12:00:00")
    return mirrors.batch_high_water(extract.changed_since(src.change_feed, cursor), cursor)


def mirror_stream_query(spark: SparkSession, path: str) -> DataFrame:
    src = RetailSource(spark, path)
    root = work_dir(spark, "stream")

    def select(events: DataFrame) -> DataFrame:
        return events.select(
            F.col("user_id").alias("id"),
            F.col("ts").cast("timestamp").alias("write_date"),
            "event_id",
            "event_type",
            F.col("value").cast("decimal(18,4)").alias("value"),
        )

    # A stream path must be a folder or a pattern; this pattern fits the one name, be it a file or a folder.
    mirror_stream.pull_available(spark, f"{path}/event[s].parquet", src.raw("events").schema, select, root)
    return mirror_stream.current(spark, root, ["id"], "write_date", ["event_id"])


QUERIES["mirror_stream"] = mirror_stream_query


def mirror_stream_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The feed streamed into a bucketed mirror in micro-batches, compacted, and loaded once more in a batch."""
    src = RetailSource(spark, path)
    mirror = _bucketed_feed(src, "stream-buckets")

    def select(events: DataFrame) -> DataFrame:
        moment = F.col("ts").cast("timestamp").alias("write_date")
        return events.select(F.col("user_id").alias("id"), moment, "event_id", "event_type", F.col("value").cast("decimal(18,4)").alias("value"))

    mirror_stream.feed(spark, f"{path}/event[s].parquet", src.raw("events").schema, select, mirror, work_dir(spark, "stream-checkpoint"))
    mirror.compact()
    mirror.load(src.change_feed, extract.in_utc, lookback=timedelta(days=5))
    return mirror.current()


QUERIES["mirror_stream_buckets"] = mirror_stream_buckets

# -- single expressions and operators ------------------------------------------------------------------------

for _name, _column, _rule in (
    ("clean_name", "name", text.clean_name),
    ("clean_email", "email", text.clean_email),
    ("clean_phone", "phone", text.clean_phone),
    ("clean_city", "city", text.clean_city),
    ("clean_street", "street", text.clean_street),
):
    _register(
        _name,
        lambda src, c=_column, rule=_rule: src.table("res_partner").select(
            "id", F.col(c).alias("raw"), rule(F.col(c)).alias("cleaned")
        ),
    )


@source_query
def partner_union(src):
    return src.customers.unionByName(src.vendors).select("id", "name", "partner_type", "city_id", "muhafaza_id")


@source_query
def date_key(src):
    return src.order_headers.select(
        "id",
        calendar.date_key(F.col("date_order")).alias("date_key"),
        calendar.iso_day_of_week(F.col("date_order")).alias("day_of_week"),
    )


@source_query
def line_amounts(src):
    lines = src.table("sale_order_line")
    net, total = money.line_amounts(
        F.col("product_uom_qty"), F.col("price_unit"), F.col("discount"), F.expr("cast((id % 16) * 0.01 as decimal(3,2))")
    )
    return lines.select("id", net.alias("price_subtotal"), total.alias("price_total"))


@source_query
def payment_date_offset(src):
    lines = explode_series(src.order_headers.select("id", "date_order"), F.expr("cast(id % 3 as int)"), "k")
    due = calendar.plus_days(F.col("date_order"), F.expr("k * 14 + id % 9"))
    return lines.select("id", "k", due.cast("timestamp").alias("due"))


@source_query
def code_format(src):
    name = F.col("name")
    return src.order_headers.select(
        "id",
        name.alias("code"),
        F.left(name, F.lit(3)).alias("head"),
        F.right(name, F.lit(4)).alias("tail"),
        F.lower(name).alias("lowered"),
    )


@source_query
def category_path(src):
    paths = src.raw("part").select("p_partkey", text.category_path(F.col("p_type"), F.col("p_brand")).alias("path"))
    return paths.groupBy("path").agg(F.count(F.lit(1)).alias("parts"))


@source_query
def variant_name(src):
    return src.table("product_product").select("id", "name", "color", "size")


@source_query
def explode_series_query(src):
    return explode_series(src.order_headers.select("id"), F.expr("cast(id % 3 as int)"), "k")


QUERIES["explode_series"] = QUERIES.pop("explode_series_query")


@source_query
def sample_k_query(src):
    """For every purchase order, one to five products from its vendor's price list."""
    orders = src.purchase_headers.select(F.col("id").alias("order_id"), "partner_id")
    offers = src.table("product_supplierinfo").select("partner_id", "product_id", "price")
    # The sampler reads its inputs several times, so both are stored first, as they are in a real source.
    root = work_dir(src.spark, "sample")
    orders = mirrors.full_refresh(orders, f"{root}/orders")
    offers = mirrors.full_refresh(offers, f"{root}/offers")
    return sample_k_per_group(
        orders,
        offers,
        group="partner_id",
        k=F.expr("1 + order_id % 5"),
        start=F.expr("(order_id % 1000003) * 6007 % 1000003"),
        shuffle_key=F.expr("((product_id % 1000003) * 6007 + (partner_id % 1000003) * 90001) % 1000003"),
        item_key="product_id",
        request_key="order_id",
    ).select("order_id", "partner_id", "pick", "product_id", "price")


QUERIES["sample_k_per_group"] = QUERIES.pop("sample_k_query")


@source_query
def sample_k_subset_query(src):
    """The same with a subset of its own for every order: two orders that share one product need not share more."""
    orders = src.purchase_headers.select(F.col("id").alias("order_id"), "partner_id")
    offers = src.table("product_supplierinfo").select("partner_id", "product_id", "price")
    root = work_dir(src.spark, "subset")
    return sample_k_per_group(
        mirrors.full_refresh(orders, f"{root}/orders"),
        mirrors.full_refresh(offers, f"{root}/offers"),
        group="partner_id",
        k=F.expr("1 + order_id % 5"),
        start=F.col("order_id"),
        shuffle_key=F.expr("(product_id * 6151 + partner_id % 1000003) % 1000003"),
        item_key="product_id",
        request_key="order_id",
        independent=True,
    ).select("order_id", "partner_id", "pick", "product_id", "price")


QUERIES["sample_k_subset"] = QUERIES.pop("sample_k_subset_query")


@source_query
def order_rollup(src):
    return rollup_totals(src.order_headers, src.table("sale_order_line")).select(
        "id", "amount_untaxed", "amount_tax", "amount_total"
    )


@source_query
def purchase_rollup(src):
    return rollup_totals(src.purchase_headers, src.table("purchase_order_line")).select(
        "id", "amount_untaxed", "amount_tax", "amount_total"
    )
