"""KPI tables kept up to date by deltas: what changed rows counted for before is taken back, what they count for now is added.

Sums per day and per customer are kept as signed partial sums, one file set per refresh. A refresh compares two commits of the bucketed
mirrors: the rows of the batches in between name the orders concerned, and only their buckets are read, once as of the old commits
and once as of the new ones. Sums and counts are additive, so days, customers, moved orders and deleted rows all come out as a full
recount would have them. One commit names the mirrors' versions and the partial sums together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.operators.bucket_mirror import BucketMirror
from bazaarlake.plans import gold, kpi
from bazaarlake.sources.commits import CommitConflict, CommitLog
from bazaarlake.sources.storage import drop_folder

#: Partial sums are added up into one once there are this many.
FOLD = 16
_SUMS = {
    "daily": ("date_key", {"lines": "bigint", "kept": "decimal(24,4)", "lost": "decimal(24,4)"}),
    "customer_sales": ("customer_key", {"lines": "bigint", "net": "decimal(24,4)", "total": "decimal(24,4)"}),
    "customer_paid": ("customer_key", {"payments": "bigint", "paid": "decimal(24,4)"}),
}
_SALES = {"date_key": "int", "customer_key": "bigint"} | _SUMS["daily"][1] | _SUMS["customer_sales"][1]


class DeltaKpis:
    """Monthly sales and sales by governorate below ``root``, from mirrors of orders (by id), their lines (by order) and payments."""

    def __init__(self, spark: SparkSession, root: str, orders: BucketMirror, lines: BucketMirror, payments: BucketMirror):
        if lines.by != ["order_id"]:
            raise ValueError("the lines' mirror must be cut by order_id")
        self.spark, self.root = spark, root
        self.orders, self.lines, self.payments = orders, lines, payments
        self.commits = CommitLog(spark, f"{root}/commits")

    def _mirrors(self) -> dict[str, BucketMirror]:
        return {"orders": self.orders, "lines": self.lines, "payments": self.payments}

    def refresh(self) -> dict[str, int]:
        """Take in what the mirrors hold beyond the last refresh; the numbers of orders and payments looked at."""
        number, state = self.commits.head()
        state = state or {"versions": dict.fromkeys(self._mirrors(), 0), "sums": {name: [] for name in _SUMS}}
        old, new = state["versions"], {n: m.state()[0] for n, m in self._mirrors().items()}
        if old == new:
            return {"orders": 0, "payments": 0}
        attempt = f"{self.root}/refresh={uuid.uuid4().hex}"
        buckets, ids = self._concerned(old, new, ("orders", "lines"), f"{attempt}/orders")
        paid_buckets, paid_ids = self._concerned(old, new, ("payments",), f"{attempt}/payments")

        def sales(versions: dict) -> DataFrame:
            orders = self.orders.as_of(versions["orders"], buckets, ids)
            return gold.fact_sales({"sale_order": orders, "sale_order_line": self.lines.as_of(versions["lines"], buckets)}.get)

        def payments(versions: dict) -> DataFrame:
            return gold.fact_payments({"account_payment": self.payments.as_of(versions["payments"], paid_buckets, paid_ids)}.get)

        def changed(fact: Callable[[dict], DataFrame], *amounts: str) -> DataFrame:
            return _signed(fact(new), 1, amounts).unionByName(_signed(fact(old), -1, amounts))

        # Orders and lines are joined once for both tables of sums; those of a day have no customer and the other way round.
        by_both = [F.col("date_key"), F.col("customer_key")]
        sold = changed(sales, "amount_untaxed", "amount_total").groupingSets([[c] for c in by_both], *by_both)
        sold = sold.agg(F.grouping("date_key").alias("_set"), F.sum("_sign").alias("lines"), *kpi.daily_amounts(), *kpi.customer_amounts())
        self._stored(sold.select("_set", *_SALES), f"{attempt}/sales")
        sold = self.spark.read.schema(f"_set tinyint, {', '.join(f'{c} {t}' for c, t in _SALES.items())}").parquet(f"{attempt}/sales")
        paid = changed(payments, "amount").groupBy("customer_key")
        parts = {
            "daily": sold.where("_set = 0"),
            "customer_sales": sold.where("_set = 1"),
            "customer_paid": paid.agg(F.sum("_sign").alias("payments"), F.sum("amount").cast("decimal(24,4)").alias("paid")),
        }
        sums = {}
        for name, part in parts.items():
            sums[name] = [*state["sums"][name], self._stored(_kept(part, name), f"{attempt}/{name}")]
            if len(sums[name]) >= FOLD:
                sums[name] = [self._stored(self._read(sums[name], name), f"{attempt}/{name}-folded")]
        if not self.commits.commit(number + 1, {"versions": new, "sums": sums}):
            drop_folder(self.spark, attempt)
            raise CommitConflict("another refresh was faster; its sums are in place")
        return {"orders": ids.count(), "payments": paid_ids.count()}

    def _concerned(self, old: dict, new: dict, names: tuple[str, ...], path: str) -> tuple[set[str], DataFrame]:
        """Buckets and ids (of orders, or payments) whose rows differ between two commits."""
        found, buckets = None, set()
        for name in names:
            touched, keys = self._mirrors()[name].changed_rows(old[name], new[name])
            buckets |= touched
            keys = keys.select(F.col(self._mirrors()[name].by[0]).alias("_concerned"))
            found = keys if found is None else found.unionByName(keys)
        found.distinct().write.parquet(path)
        return buckets, self.spark.read.schema("_concerned bigint").parquet(path)

    def _stored(self, df: DataFrame, path: str) -> str:
        df.write.parquet(path)
        return path

    def _read(self, paths: list[str], name: str) -> DataFrame:
        key, sums = _SUMS[name]
        fields = ", ".join([f"{key} {'int' if key == 'date_key' else 'bigint'}", *(f"{c} {t}" for c, t in sums.items())])
        return _added(self.spark.read.schema(fields).parquet(*paths), name)

    def sums(self, name: str) -> DataFrame:
        """Sums per day or customer as of the last refresh."""
        _, state = self.commits.head()
        if state is None:
            raise FileNotFoundError("no refresh has been made")
        return self._read(state["sums"][name], name)

    def monthly_sales(self, calendar: DataFrame) -> DataFrame:
        return kpi.monthly_sales(calendar, self.sums("daily"))

    def sales_by_governorate(self, customers: DataFrame) -> DataFrame:
        return kpi.sales_by_governorate(self.sums("customer_sales"), self.sums("customer_paid").drop("payments"), customers)


def _signed(fact: DataFrame, sign: int, amounts: Sequence[str]) -> DataFrame:
    """Facts that count (1), or are taken back (-1)."""
    return fact.withColumns({c: -F.col(c) for c in amounts if sign < 0} | {"_sign": F.lit(sign).cast("bigint")})


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Keys whose rows have all been taken back are dropped, and so are parts that cancel out."""
    key, sums = _SUMS[name]
    out = df.select(key, *[F.coalesce(c, F.lit(0)).cast(t).alias(c) for c, t in sums.items()])
    return out.where(" OR ".join(f"{c} <> 0" for c in sums))


def _added(df: DataFrame, name: str) -> DataFrame:
    """One row per key."""
    key, sums = _SUMS[name]
    return _kept(df.groupBy(key).agg(*[F.sum(c).alias(c) for c in sums]), name)
