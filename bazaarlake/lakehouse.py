"""The whole lakehouse as jobs on stored tables: mirror a source, build the star schema, keep it compact.

A build of the star schema reads every mirror as of one commit, writes every table to a folder of its own, and then names all of them
in one commit. Readers go by that commit: facts and dimensions they see are of one build and one state of the mirrors, and a build
that fails halfway changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from bazaarlake import schema
from bazaarlake.operators.bucket_mirror import BucketMirror
from bazaarlake.operators.mirror import full_refresh
from bazaarlake.plans import gold, refresh
from bazaarlake.plans.delta_kpi import DeltaKpis
from bazaarlake.plans.silver import mirror_select
from bazaarlake.sources import storage
from bazaarlake.sources.commits import CommitLog

DIMENSIONS = (gold.dim_customer, gold.dim_vendor, gold.dim_product, gold.dim_location)
FACTS = (gold.fact_sales, gold.fact_payments, gold.fact_purchases, gold.fact_inventory)
#: Lines lie with their order, so that the two are joined bucket by bucket.
BY = {"sale_order_line": ("order_id",), "purchase_order_line": ("order_id",)}
#: Tables of a few thousand rows at any scale.
SMALL = ("muhafazat", "cities", "product_category", "stock_location")


class Snapshot:
    """One build: the star schema, and the mirrors it was made of."""

    def __init__(self, house: Lakehouse, manifest: dict):
        self._house, self._manifest = house, manifest

    def gold(self, table: str) -> DataFrame:
        return self._house.spark.read.parquet(self._manifest["gold"][table])

    def silver(self, table: str) -> DataFrame:
        return self._house.mirror(table).current(self._manifest["silver"][table])


class Lakehouse:
    """Stored tables below ``root``: ``silver/`` mirrors in key buckets, ``gold/`` star schema, ``bronze/`` full copies, ``kpi/`` partial sums.

    Tables of one step do not depend on each other; ``at_once`` of them are submitted side by side, so that small ones do
    not wait for large ones. A step is over when all its tables are; the first failure is then raised. ``buckets`` should let a
    bucket of the largest table fit a task; it is fixed once tables have been loaded.
    """

    def __init__(self, spark: SparkSession, root: str, at_once: int = 4, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.at_once = at_once
        self.buckets = buckets
        self.builds = CommitLog(spark, f"{self.root}/gold/commits")
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def _each(self, job: Callable, items: Iterable) -> list:
        with ThreadPoolExecutor(self.at_once) as pool:
            return list(pool.map(job, items))

    def mirror(self, table: str) -> BucketMirror:
        buckets = 1 if table in SMALL else self.buckets
        return BucketMirror(self.spark, f"{self.root}/silver", table, by=BY.get(table, ()), buckets=buckets)

    def load_silver(self, source, lookback: timedelta | None = None) -> dict[str, int]:
        """One incremental run over all source tables; rows loaded per table."""
        loaded = self._each(
            lambda t: self.mirror(t).load(source.table(t), lambda df: mirror_select(df, t), lookback), schema.TABLES
        )
        return dict(zip(schema.TABLES, loaded, strict=True))

    def reconcile(self, source, tables: Iterable[str] = schema.TABLES) -> dict[str, dict[str, int]]:
        """Make mirrors equal to the source as it is now, deleted rows included; what was found per table."""
        tables = list(tables)
        found = self._each(lambda t: self.mirror(t).reconcile(source.table(t), lambda df: mirror_select(df, t)), tables)
        return dict(zip(tables, found, strict=True))

    def compact(self) -> dict[str, int]:
        """Fold later batches into the buckets they touched; buckets rewritten per table."""
        return dict(zip(schema.TABLES, self._each(lambda t: self.mirror(t).compact(), schema.TABLES), strict=True))

    def silver(self, table: str) -> DataFrame:
        return self.mirror(table).current()

    def build_gold(self, keep: int = 2) -> int:
        """Rebuild every dimension and fact from the mirrors as they are at the start; the build's number.

        Facts are stored in their sort order. Folders of builds before the last ``keep`` are deleted.
        """
        versions = {t: self.mirror(t).state()[0] for t in schema.TABLES}
        build = uuid.uuid4().hex
        tables = {f.__name__: f"{self.root}/gold/{f.__name__}/build={build}" for f in (gold.dim_date, *DIMENSIONS, *FACTS)}

        def silver(table: str) -> DataFrame:
            return self.mirror(table).current(versions[table])

        try:
            gold.dim_date(self.spark).write.parquet(tables["dim_date"])
            self._each(lambda f: f(silver).write.parquet(tables[f.__name__]), DIMENSIONS)
            self._each(lambda f: storage.write_sorted(f(silver), tables[f.__name__], gold.FACT_SORT[f.__name__]), FACTS)
        except BaseException:
            for path in tables.values():
                storage.drop_folder(self.spark, path)
            raise
        manifest = {"silver": versions, "gold": tables}
        number = self.builds.head()[0] + 1
        while not self.builds.commit(number, manifest):
            number += 1
        for old in range(max(1, number - 2 * keep), number - keep + 1):
            for path in self.builds.read(old)["gold"].values():
                storage.drop_folder(self.spark, path)
        return number

    def snapshot(self, number: int | None = None) -> Snapshot:
        """A build of the star schema, the last one if no number is given. It stays as it is while later builds come."""
        number, manifest = self.builds.head() if number is None else (number, self.builds.read(number))
        if manifest is None:
            raise FileNotFoundError(f"no build below {self.root}")
        return Snapshot(self, manifest)

    def gold(self, table: str) -> DataFrame:
        return self.snapshot().gold(table)

    def kpis(self) -> DeltaKpis:
        """KPI tables kept by deltas; ``refresh()`` takes in what has been loaded since."""
        mirrors = (self.mirror(t) for t in ("sale_order", "sale_order_line", "account_payment"))
        return DeltaKpis(self.spark, f"{self.root}/kpi", *mirrors)

    def refresh_bronze(self, source) -> None:
        """Replace the nine full copies by the source as it is now."""
        bronze = refresh.bronze_of(source)
        self._each(lambda t: full_refresh(bronze(t), f"{self.root}/bronze/{t}"), schema.REFRESH_TABLES)

    def bronze(self, table: str) -> DataFrame:
        return storage.read_published(self.spark, f"{self.root}/bronze/{table}")
