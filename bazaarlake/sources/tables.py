"""The retail source tables as views over the test data.

The test data has TPC-H-like tables; the retail model is derived from them by fixed formulas. Values the test
data has no counterpart for (phones, e-mails, colours, states) come from arithmetic on the row's own key, so
they do not depend on partitioning. Nothing here is needed when a real source with these 14 tables is read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake import schema
from bazaarlake.functions.calendar import plus_days
from bazaarlake.functions.text import category_path, padded_code, variant_name
from bazaarlake.operators.joins import skew_join
from bazaarlake.operators.rollup import line_totals, rollup_totals
from bazaarlake.operators.series import explode_series

# Vendors follow the customers in one id space; wide enough that customer keys never reach it.
VENDOR_OFFSET = 1_000_000_000_000_000
# Row ids of a table stored in several files: file number times this, plus the row's place in its file.
FILE_STRIDE = 1 << 40
LOCATIONS = 15
BASE = "timestamp_ntz'1995-01-01 00:00:00'"


def _days_after_base(n: str) -> Column:
    return plus_days(F.expr(BASE), F.expr(n))


def _hundredths(column: str) -> Column:
    """A non-negative double with two decimals as a whole number of hundredths."""
    return F.expr(f"cast({column} * 100 + 0.5D as bigint)")


def _from_cents(cents: str, type_: str) -> Column:
    return F.expr(f"cast(cast({cents} as decimal(14,0)) * 0.01BD as {type_})")


class RetailSource:
    """``table(name)`` gives one of the 14 source tables; ``raw(name)`` a test data table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._raw[name]

    def table(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}").select(*[c.name for c in schema.columns(name)])

    def store(self, name: str, path: str) -> None:
        """Write a table and read it from there from now on; so do tables derived from it that have not been asked for yet."""
        found = getattr(self, f"_{name}")
        found.write.parquet(path)
        setattr(self, f"_{name}", self.spark.read.schema(found.schema).parquet(path))

    # -- geography ---------------------------------------------------------------------------------------

    @cached_property
    def _muhafazat(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").alias("id"),
            F.col("r_name").alias("name"),
            F.col("r_name").alias("name_ar"),
            F.concat(F.lit("R-"), F.col("r_regionkey")).alias("code"),
            F.expr(f"{BASE} as create_date"),
            F.expr(f"{BASE} as write_date"),
        )

    @cached_property
    def _cities(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("id"),
            F.col("n_regionkey").alias("muhafaza_id"),
            F.col("n_name").alias("name"),
            F.expr("if(n_nationkey % 4 = 0, null, n_name) as name_ar"),
            F.expr(f"{BASE} as create_date"),
            F.expr(f"{BASE} as write_date"),
        )

    # -- partners ----------------------------------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        """Customers with faults to clean. Which of them a row has follows from the cents of its balance, each fault by
        a divisor of its own, so that they meet in every combination; contact data follows segment and nation."""
        c = self.raw("customer").join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        c = c.withColumns(
            {
                "cents": F.expr("cast(abs(round(c_acctbal * 100)) as bigint)"),
                "segment": F.lower("c_mktsegment"),
            }
        ).withColumns(
            {
                "gap": F.expr("if(cents % 3 = 0, '   ', ' ')"),
                "indent": F.expr("if(cents % 2 = 0, '  ', '')"),
                "mailbox": F.expr("concat('desk', cast(c_custkey div 3 as string), '@', segment, '.example')"),
                "number": F.expr("lpad(cast((c_custkey * 31 + cents) % 100000000 as string), 8, '0')"),
            }
        )
        shouted = F.col("n_nationkey") % 2 == 1
        name = F.concat("indent", "segment", "gap", F.lit("buyer"), "gap", F.col("c_custkey"), "indent")
        first, last = F.left("number", F.lit(4)), F.right("number", F.lit(4))
        # The three forms of a phone number that cleaning accepts.
        phone = (
            F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("010"), "number"))
            .when(F.col("n_nationkey") % 4 == 1, F.concat(F.lit("+20 10 "), first, F.lit(" "), last))
            .when(F.col("n_nationkey") % 4 == 2, F.concat(F.lit("010-"), first, F.lit("-"), last))
        )
        return c.select(
            F.col("c_custkey").alias("id"),
            F.when(shouted, F.upper(name)).otherwise(name).alias("name"),
            F.when(F.col("cents") % 11 != 0, F.concat("indent", F.when(shouted, F.upper("mailbox")).otherwise(F.col("mailbox")))).alias(
                "email"
            ),
            phone.alias("phone"),
            F.expr("if(cents % 7 = 0, indent, concat(n_name, ' road ', cast(c_custkey % 90 + 1 as string)))").alias("street"),
            F.expr("CASE n_regionkey WHEN 0 THEN lower(n_name) WHEN 1 THEN concat(indent, n_name) WHEN 2 THEN NULL ELSE n_name END").alias(
                "city"
            ),
            F.expr("if(cents % 4 = 1, null, n_nationkey) as city_id"),
            F.col("n_regionkey").alias("muhafaza_id"),
            F.expr("c_acctbal >= 5000 as is_company"),
            F.lit("customer").alias("partner_type"),
            F.col("c_mktsegment").alias("segment"),
            F.expr("cents % 10 <> 3 as active"),
            _days_after_base("c_custkey % 1500").alias("create_date"),
            _days_after_base("c_custkey % 1500 + cents % 365").alias("write_date"),
        )

    @cached_property
    def vendors(self) -> DataFrame:
        s = self.raw("supplier").join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        s = s.withColumn("cents", F.expr("cast(abs(round(s_acctbal * 100)) as bigint)"))
        return s.select(
            (F.col("s_suppkey") + VENDOR_OFFSET).alias("id"),
            F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit(" no. "))).alias("name"),
            F.expr("concat('orders@', lower(replace(s_name, '#', '')), '.example') as email"),
            F.expr("concat('0', cast(40 + n_nationkey as string), ' ', lpad(cast(cents % 10000000 as string), 7, '0')) as phone"),
            F.expr("concat('Dock ', cast(s_suppkey % 12 + 1 as string), ', ', n_name) as street"),
            F.col("n_name").alias("city"),
            F.col("n_nationkey").alias("city_id"),
            F.col("n_regionkey").alias("muhafaza_id"),
            F.lit(True).alias("is_company"),
            F.lit("vendor").alias("partner_type"),
            F.lit(None).cast("string").alias("segment"),
            F.expr("cents % 40 <> 7 as active"),
            _days_after_base("s_suppkey % 1500").alias("create_date"),
            _days_after_base("s_suppkey % 1500 + n_nationkey").alias("write_date"),
        )

    @cached_property
    def _res_partner(self) -> DataFrame:
        return self.customers.unionByName(self.vendors)

    # -- products ----------------------------------------------------------------------------------------

    @cached_property
    def _product_category(self) -> DataFrame:
        """Two levels: the part type and, below it, the brand. A node's id is twice the smallest part key of
        the node plus 1 or 2: unique, stable as parts are added, and found without ranking all nodes."""
        brands = self.raw("part").groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("first_part"))
        parents = brands.groupBy("p_type").agg(F.min("first_part").alias("first_part")).select(
            F.expr("cast(first_part * 2 + 1 as int) as id"),
            F.col("p_type").alias("name"),
            F.lit(None).cast("int").alias("parent_id"),
            F.col("p_type").alias("complete_name"),
        )
        # Over the distinct brands only: a few rows per type however many parts it has.
        first_of_type = F.min("first_part").over(Window.partitionBy("p_type"))
        children = brands.select(
            F.expr("cast(first_part * 2 + 2 as int) as id"),
            F.col("p_brand").alias("name"),
            (first_of_type * 2 + 1).cast("int").alias("parent_id"),
            category_path(F.col("p_type"), F.col("p_brand")).alias("complete_name"),
        )
        return parents.unionByName(children).select(
            "*", F.expr(f"{BASE} as create_date"), F.expr(f"{BASE} as write_date")
        )

    @cached_property
    def _parts(self) -> DataFrame:
        """Parts with what they share within their template: three consecutive keys form one template."""
        part = self.raw("part").select(
            "*",
            F.expr("p_partkey div 3 as tmpl"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("own_price"),
        )
        first = Window.partitionBy("tmpl").orderBy("p_partkey")
        return part.select(
            "*",
            F.row_number().over(first).alias("place"),
            F.concat(F.first("p_name").over(first), F.lit(" "), F.col("tmpl")).alias("tmpl_name"),
            F.min("own_price").over(Window.partitionBy("tmpl")).alias("list_price"),
        )

    @cached_property
    def _product_template(self) -> DataFrame:
        node = self._product_category.select(F.col("id").alias("categ_id"), F.col("complete_name").alias("path"))
        # Every 25th template hangs on a top category.
        path = F.when(F.col("tmpl") % 25 == 0, F.col("p_type")).otherwise(
            category_path(F.col("p_type"), F.col("p_brand"))
        )
        return (
            self._parts.where("place = 1")
            .join(node, path == F.col("path"), "left")
            .select(
                F.col("tmpl").alias("id"),
                F.col("tmpl_name").alias("name"),
                "categ_id",
                padded_code("M", F.col("tmpl"), 9).alias("default_code"),
                "list_price",
                F.expr("cast(round(list_price * 0.60, 2) as decimal(12,2)) as standard_price"),
                F.lit("product").alias("type"),
                F.expr("tmpl % 18 <> 4 as active"),
                _days_after_base("tmpl % 911").alias("create_date"),
                _days_after_base("tmpl % 911 + tmpl % 37").alias("write_date"),
            )
        )

    @cached_property
    def _product_product(self) -> DataFrame:
        attributes = self._parts.withColumns(
            {
                "color": F.expr("if(p_partkey % 7 = 0, null, substring_index(p_name, ' ', 1))"),
                "size": F.expr("if(p_partkey % 5 < 2, null, concat('SZ', cast(p_size as string)))"),
            }
        )
        return attributes.select(
            F.col("p_partkey").alias("id"),
            F.col("tmpl").alias("product_tmpl_id"),
            padded_code("V", F.col("p_partkey"), 9).alias("default_code"),
            F.when(F.col("p_size") % 16 != 0, padded_code("4", F.col("p_partkey"), 12)).alias("barcode"),
            variant_name(F.col("tmpl_name"), F.col("color"), F.col("size")).alias("name"),
            "color",
            "size",
            (F.col("own_price") - F.col("list_price")).cast("decimal(12,2)").alias("price_extra"),
            F.expr("tmpl % 18 <> 4 and p_size <> 13 as active"),
            _days_after_base("tmpl % 911").alias("create_date"),
            _days_after_base("tmpl % 911 + tmpl % 37").alias("write_date"),
        )

    @cached_property
    def _product_supplierinfo(self) -> DataFrame:
        """One offer per (product, vendor) seen on a line, at 90 to 110 % of the product's cost, by vendor."""
        offers = self._line_keys.groupBy("l_partkey", "l_suppkey").agg(F.min("id").alias("id"))
        price = self.raw("part").select("p_partkey", F.col("p_retailprice").cast("decimal(12,2)").alias("base"))
        return skew_join(offers, price, [("l_partkey", "p_partkey")], ["id"], "left").select(
            "id",
            F.col("l_partkey").alias("product_id"),
            (F.col("l_suppkey") + VENDOR_OFFSET).alias("partner_id"),
            F.expr(
                "cast(round(base * 0.60 * cast((90 + l_suppkey % 5 * 5) * 0.01 as decimal(5,2)), 2) as decimal(12,2)) as price"
            ),
            F.expr("cast(6 * (1 + l_partkey % 4) as decimal(12,3)) as min_qty"),
            F.expr("cast(2 + l_suppkey % 21 as int) as delay"),
            F.expr(f"{BASE} as create_date"),
            F.expr(f"{BASE} as write_date"),
        )

    # -- stock -------------------------------------------------------------------------------------------

    @cached_property
    def _stock_location(self) -> DataFrame:
        span = (
            self.raw("nation")
            .groupBy(F.col("n_regionkey").alias("region"))
            .agg(F.min("n_nationkey").alias("first_city"), F.max("n_nationkey").alias("last_city"))
        )
        kinds = F.explode(
            F.expr(
                """array(named_struct('k', 0, 'kind', 'warehouse', 'prefix', 'depot-'),
                         named_struct('k', 1, 'kind', 'store', 'prefix', 'shop-'),
                         named_struct('k', 2, 'kind', 'transit', 'prefix', 'van-'))"""
            )
        )
        places = self.raw("region").join(span, F.col("r_regionkey") == F.col("region"), "left").withColumn("t", kinds)
        return places.select(
            F.expr("r_regionkey * 3 + t.k as id"),
            F.concat_ws(" ", "r_name", "t.kind").alias("name"),
            F.concat("t.prefix", "r_regionkey").alias("code"),
            F.col("t.kind").alias("location_type"),
            F.col("r_regionkey").alias("muhafaza_id"),
            F.expr("CASE t.k WHEN 0 THEN first_city WHEN 1 THEN last_city END AS city_id"),
            F.expr(f"{BASE} as create_date"),
            F.expr(f"{BASE} as write_date"),
        )

    @cached_property
    def _stock_quant(self) -> DataFrame:
        """One to three lots of a part, by its size; a quarter of each is reserved."""
        lots = explode_series(self.raw("part").select("p_partkey", "p_size"), F.expr("cast(1 + p_size % 3 as int)"), "k")
        lots = lots.withColumn("held", F.expr("cast((p_size * 17 + k * 90) % 400 as decimal(12,3))"))
        return lots.select(
            F.expr("p_partkey * 3 + k as id"),
            F.col("p_partkey").alias("product_id"),
            F.expr(f"cast((p_partkey + k * 4) % {LOCATIONS} as int) as location_id"),
            F.col("held").alias("quantity"),
            F.expr("cast(held * 0.25BD as decimal(12,3)) as reserved_quantity"),
            _days_after_base("p_partkey % 911").alias("create_date"),
            _days_after_base("(p_partkey % 911) + k").alias("write_date"),
        )

    # -- sales -------------------------------------------------------------------------------------------

    @cached_property
    def order_headers(self) -> DataFrame:
        """Orders before their amounts are rolled up from the lines."""
        zero = F.lit(0).cast("decimal(14,2)")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            padded_code("S", F.col("o_orderkey"), 8).alias("name"),
            F.col("o_custkey").alias("partner_id"),
            F.expr(f"cast(o_orderkey % {LOCATIONS} as int) as location_id"),
            F.col("o_orderdate").alias("date_order"),
            F.expr(
                """CASE WHEN o_orderkey % 12 = 0 THEN 'cancel'
                        WHEN o_orderkey % 12 = 1 THEN 'sent'
                        WHEN o_orderstatus = 'O' THEN 'sale'
                        WHEN o_orderstatus = 'F' THEN 'done'
                        ELSE 'draft' END AS state"""
            ),
            zero.alias("amount_untaxed"),
            zero.alias("amount_tax"),
            zero.alias("amount_total"),
            F.col("o_orderdate").alias("create_date"),
            F.col("o_orderdate").alias("write_date"),
        )

    @cached_property
    def _sale_order(self) -> DataFrame:
        return rollup_totals(self.order_headers, self._sale_order_line)

    @cached_property
    def _line_keys(self) -> DataFrame:
        """Lines with a row id. (order, line number) repeats, so the id is the row's place in storage, like a
        serial column: the place in its file, files numbered by path. One file needs no numbers. The numbers of several are a
        row per file, made from the same metadata column that the lines are matched on, so no line is lost; they
        are broadcast where the planner finds them small enough."""
        lines = self.raw("lineitem")
        if len(lines.inputFiles()) == 1:
            return lines.select((F.col("_metadata.row_index") + 1).alias("id"), *lines.columns)
        path = F.col("_metadata.file_path")
        files = lines.select(path.alias("_file")).distinct()
        files = files.select("_file", (F.row_number().over(Window.orderBy("_file")) - 1).alias("_file_no"))
        return (
            lines.select((F.col("_metadata.row_index") + 1).alias("_place"), path.alias("_at_file"), "*")
            .join(files, F.col("_at_file") == F.col("_file"))
            .select((F.col("_file_no") * FILE_STRIDE + F.col("_place")).alias("id"), *lines.columns)
        )

    @cached_property
    def _amounts(self) -> DataFrame:
        """Lines with their money in whole cents: integer arithmetic is exact and much cheaper than decimal."""
        lines = self._line_keys.withColumns(
            {
                "qty": F.col("l_quantity").cast("bigint"),
                "cents": _hundredths("l_extendedprice"),
                "tax_pct": _hundredths("l_tax"),
            }
        )
        return lines.withColumns(
            {
                "net": _from_cents("cents", "decimal(14,2)"),
                "total": _from_cents("(cents * (100 + tax_pct) + 50) div 100", "decimal(14,2)"),
                "unit": _from_cents("(cents * 2 + qty) div (qty * 2)", "decimal(12,2)"),
            }
        )

    @cached_property
    def _sale_order_line(self) -> DataFrame:
        return self._amounts.select(
            "id",
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("qty").cast("decimal(12,3)").alias("product_uom_qty"),
            F.col("unit").alias("price_unit"),
            _hundredths("l_discount").cast("decimal(5,2)").alias("discount"),
            F.col("net").alias("price_subtotal"),
            F.col("total").alias("price_total"),
            F.col("l_shipdate").alias("create_date"),
            F.col("l_shipdate").alias("write_date"),
        )

    @cached_property
    def _account_payment(self) -> DataFrame:
        """Up to three monthly instalments of an order. Of every third order one more is still to come; the last one
        due takes the cents that do not divide evenly, so that paid orders come out exact."""
        orders = self._sale_order.withColumns(
            {
                "n_pay": F.expr("CASE state WHEN 'cancel' THEN 0 WHEN 'draft' THEN 0 WHEN 'sent' THEN id % 2 ELSE id % 4 END"),
                "cents": F.expr("cast(amount_total * 100 as bigint)"),
            }
        ).withColumn("n_due", F.expr("n_pay + if(id % 3 = 0, 1, 0)"))
        paid = explode_series(orders, F.col("n_pay").cast("int"), "k").withColumns(
            {
                "part": F.expr("cents div n_due + if(k = n_due, cents % n_due, 0)"),
                "pay_state": F.expr("CASE WHEN state = 'sent' THEN 'draft' WHEN k < n_due THEN 'posted' ELSE 'reconciled' END"),
            }
        )
        return paid.select(
            F.expr("id * 4 + k as id"),
            F.concat(padded_code("R", F.col("id"), 8), F.lit("-"), F.col("k")).alias("name"),
            "partner_id",
            F.col("id").alias("sale_order_id"),
            _from_cents("part", "decimal(14,2)").alias("amount"),
            F.lit("inbound").alias("payment_type"),
            F.lit("customer").alias("partner_type"),
            F.expr("if(k = 1, 'bank', 'cash') as journal"),
            F.expr("if(state = 'done', 'electronic', 'manual') as payment_method"),
            F.col("pay_state").alias("state"),
            F.when(F.col("pay_state") != "draft", plus_days(F.col("date_order"), F.expr("k * 30"))).alias("payment_date"),
            "create_date",
            "write_date",
        )

    # -- purchases ---------------------------------------------------------------------------------------

    @cached_property
    def _purchase_order_line(self) -> DataFrame:
        """The lines again, as bought from their supplier; one order per supplier and month."""
        return self._amounts.select(
            "id",
            F.expr("l_suppkey * 100000 + year(l_shipdate) * 12 + month(l_shipdate) as order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("qty").cast("decimal(12,3)").alias("product_qty"),
            F.col("unit").alias("price_unit"),
            F.col("net").alias("price_subtotal"),
            F.col("total").alias("price_total"),
            F.col("l_shipdate").alias("create_date"),
            F.col("l_shipdate").alias("write_date"),
        )

    def _purchase_columns(self, orders: DataFrame, net: Column, tax: Column, total: Column) -> DataFrame:
        month = F.expr("make_timestamp_ntz(cast((id % 100000 - 1) div 12 as int),"
                       " cast((id % 100000 - 1) % 12 + 1 as int), 1, 0, 0, 0)")
        return orders.select(
            "id",
            padded_code("PO", F.col("id"), 7).alias("name"),
            (F.expr("id div 100000") + VENDOR_OFFSET).alias("partner_id"),
            F.expr(f"if(id % 8 = 3, null, cast(id % {LOCATIONS} as int)) as location_id"),
            month.alias("date_order"),
            F.expr(
                """CASE id % 9 WHEN 4 THEN 'cancel' WHEN 5 THEN 'draft' WHEN 6 THEN 'sent'
                        ELSE if(id % 2 = 0, 'done', 'purchase') END AS state"""
            ),
            net.cast("decimal(14,2)").alias("amount_untaxed"),
            tax.cast("decimal(14,2)").alias("amount_tax"),
            total.cast("decimal(14,2)").alias("amount_total"),
            month.alias("create_date"),
            month.alias("write_date"),
        )

    @cached_property
    def purchase_headers(self) -> DataFrame:
        """Purchase orders before their amounts are rolled up."""
        keys = self._purchase_order_line.select(F.col("order_id").alias("id")).distinct()
        return self._purchase_columns(keys, F.lit(0), F.lit(0), F.lit(0))

    @cached_property
    def _purchase_order(self) -> DataFrame:
        totals = line_totals(self._purchase_order_line).withColumnRenamed("_header", "id")
        return self._purchase_columns(totals, F.col("_net"), F.col("_total") - F.col("_net"), F.col("_total"))

    # -- change feed -------------------------------------------------------------------------------------

    @cached_property
    def change_feed(self) -> DataFrame:
        """Events as versions of their user's row: the key is the user, the cursor the event time."""
        return self.raw("events").select(
            F.col("user_id").alias("id"),
            F.col("ts").alias("write_date"),
            "event_id",
            "event_type",
            F.col("value").cast("decimal(18,4)").alias("value"),
        )
