"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.session import work_dir

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows written to the shared checkpoint folder and read from there, so lost executors cost no rerun.

    The folder is the one that ``spark.checkpoint.dir`` names; a session without it (a test) gets its own.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark, "checkpoints"))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, but as Parquet: less disk for long tables, and readers take only the columns they want."""
    path = work_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 100_000, cells: Column | None = None) -> DataFrame:
    """``df`` marked for broadcast if a count finds at most ``rows`` narrow rows, else as it is.

    Rows that hold lists are not narrow: ``cells`` gives what a row counts for. ``df`` should be a table already cut. Only the join
    strategy depends on the count; beyond the bound Spark's sort-merge join with skew splitting does the same work.
    """
    n = df.count() if cells is None else df.agg(F.coalesce(F.sum(cells), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(df) if n <= rows else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have yet."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def clear_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Columns of ``df`` whose names an operator is about to add are kept under ``in_<name>``."""
    wanted = {n.lower() for n in names}
    for c in df.columns:
        if c.lower() in wanted:
            df = df.withColumnRenamed(c, fresh(df, f"in_{c}")[0])
    return df


def row_id(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The document's id; a document without one goes by a hash of its text (negative, so apart from real ids)."""
    return F.coalesce(F.col(doc_id).cast("long"), -F.abs(F.xxhash64(F.lit("no id"), F.col(text))))


#: Names of an id's further texts begin here; ids are below.
FURTHER = 1 << 62


def row_name(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: one number for each pair of id and text.

    That is the id itself (``row_id``) unless rows repeat the id with different texts. Then it goes to the text of the smallest
    hash, and each further text has a number from ``FURTHER`` on, made of id and text. Ids are counted in one narrow
    shuffle; texts stay put as long as few ids have several.
    """
    rid, th, first = fresh(docs, "_name_rid", "_name_th", "_name_first")
    keyed = docs.withColumn(rid, row_id(doc_id, text)).withColumn(th, F.xxhash64(F.col(text)))
    firsts = keyed.groupBy(rid).agg(F.min(th).alias(first), F.max(th).alias(th)).where(F.col(first) != F.col(th)).drop(th)
    further = F.lit(FURTHER) + F.shiftrightunsigned(F.xxhash64(rid, th), 2)
    own = F.when(F.col(first) != F.col(th), further).otherwise(F.col(rid))
    return keyed.join(small(cut(firsts), 1_000_000), rid, "left").withColumn(name, own).drop(rid, th, first)


def occurrences(rows: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """``rows`` with a column ``name``: 1, 2, ... among rows that agree in ``key``.

    A key is numbered task by task and the parts are put together by their sizes, so no task holds a key's rows whole. Which
    of its rows has which number is open: for rows that are alike.
    """
    piece, at, n, before = fresh(rows, "_piece", "_at", "_n", "_before")
    placed = cut(rows.withColumn(piece, F.spark_partition_id()))
    local = placed.withColumn(at, F.row_number().over(Window.partitionBy(*key, piece).orderBy(piece)))
    earlier = Window.partitionBy(*key).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*key, piece).agg(F.count(F.lit(1)).alias(n))
    sizes = sizes.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).drop(n)
    theirs = {c: fresh(placed, f"_of_{c}")[0] for c in (*key, piece)}
    sizes = sizes.select(*[F.col(c).alias(t) for c, t in theirs.items()], before)
    same = [F.col(c).eqNullSafe(F.col(t)) for c, t in theirs.items()]
    return local.join(sizes, same).withColumn(name, F.col(before) + F.col(at)).drop(piece, at, before, *theirs.values())
