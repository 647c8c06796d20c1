"""Sets of keys as stored bitmaps, for checks of new batches that don't read the tables they refer to.

A bitmap row covers 32,768 consecutive ids with 4 kB; each batch of a table stores the bitmap rows of its ids, and a table's set is
the union of its batches' rows. A foreign key is checked by one lookup of a bit per distinct key, uniqueness by comparing counts of
bits. Ids are whole numbers; scattered ones cost a row each, dense ones a bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.sources import storage

_BITMAP = "bucket bigint, bits binary"


def key_bits(df: DataFrame, column: str) -> DataFrame:
    """The set of a column's values: (bucket, bits), NULL left out. Equal keys are one bit however often they come."""
    key = F.col(column).cast("bigint")
    rows = df.where(key.isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("bucket"))
    return rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))


def united(bits: DataFrame) -> DataFrame:
    return bits.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def has_bit(bits: Column, position: Column) -> Column:
    """Whether a bitmap (NULL: an empty one) has a bit. Bytes are read from the left, bits of a byte from the right."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.pow(F.lit(2), F.pmod(position, F.lit(8))).cast("int"))
    return F.coalesce(bit != 0, F.lit(False))


class KeyBitmaps:
    """Stored key sets below ``root``, a folder per table and batch. A batch repeated replaces its own."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def add(self, table: str, batch: int, rows: DataFrame, column: str = "id") -> None:
        key_bits(rows, column).write.mode("overwrite").parquet(f"{self.root}/{table}/batch={batch}")

    def bits(self, table: str, upto: int | None = None) -> DataFrame:
        """The set of a table's keys, of the batches up to a number if one is given."""
        batches = [b for b in storage.numbered_children(self.spark, f"{self.root}/{table}", "batch") if upto is None or b <= upto]
        if not batches:
            return self.spark.createDataFrame([], _BITMAP)
        return united(self.spark.read.schema(_BITMAP).parquet(*[f"{self.root}/{table}/batch={b}" for b in batches]))

    def fold(self, table: str) -> None:
        """Unite a table's batches into its last one; readers of the others should be done."""
        batches = storage.numbered_children(self.spark, f"{self.root}/{table}", "batch")
        if len(batches) > 1:
            draft = f"{self.root}/{table}-folded"
            self.bits(table).write.mode("overwrite").parquet(draft)
            self.spark.read.schema(_BITMAP).parquet(draft).write.mode("overwrite").parquet(f"{self.root}/{table}/batch={batches[-1]}")
            storage.drop_children(self.spark, f"{self.root}/{table}", "batch", batches[-2])
            storage.drop_folder(self.spark, draft)

    def missing(self, child: DataFrame, fk: str, parent: str) -> DataFrame:
        """(key, rows) of foreign key values that no batch of the parent has; NULL keys pass.

        Child rows are counted per key first; a key meets one bitmap row, and no row of the parent is read.
        """
        key = F.col(fk).cast("bigint")
        asked = child.where(key.isNotNull()).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("rows"))
        asked = asked.withColumn("asked", F.bitmap_bucket_number("key"))
        held = self.bits(parent)
        found = asked.join(held, F.col("asked") == F.col("bucket"), "left")
        return found.where(~has_bit(F.col("bits"), F.bitmap_bit_position("key"))).select("key", "rows")

    def repeats(self, table: str, batch: int, rows: DataFrame, column: str = "id") -> DataFrame:
        """One row: rows of a new batch beyond the first of their key (``within``), and keys of it that earlier batches have (``before``)."""
        key = F.col(column).cast("bigint")
        new = rows.where(key.isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("bucket"))
        new = new.agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"), F.count(F.lit(1)).alias("n"))
        both = new.unionByName(self.bits(table, batch - 1).withColumn("n", F.lit(None).cast("bigint")))
        bits = F.bitmap_count("bits")
        each = both.groupBy("bucket").agg(
            F.sum("n").alias("keys"),
            F.sum(F.when(F.col("n").isNotNull(), bits)).alias("new"),
            F.coalesce(F.sum(F.when(F.col("n").isNull(), bits)), F.lit(0)).alias("held"),
            F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"),
        )
        zero = F.lit(0).cast("bigint")
        return each.where("keys > 0").agg(
            F.coalesce(F.sum(F.col("keys") - F.col("new")), zero).alias("within"),
            F.coalesce(F.sum(F.col("new") + F.col("held") - F.col("either")), zero).alias("before"),
        )
