"""Reading source tables: full, incremental, inferred, or over JDBC."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import schema

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
JDBC_FETCH_ROWS = 50_000


def read_jdbc(
    spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, properties: dict | None = None
) -> DataFrame:
    """A database table read in parallel ranges of its id, streamed in chunks by each task."""
    return spark.read.jdbc(
        url,
        table,
        column="id",
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties={"fetchsize": str(JDBC_FETCH_ROWS), **(properties or {})},
    )


def range_predicates(df: DataFrame, column: str, pieces: int) -> list[str]:
    """Conditions that cut a table into ``pieces`` ranges of ``column`` of about equal row counts; each row meets exactly one.

    Split points come from a quantile sketch that tasks merge, exact to a hundredth of a piece. A value with more rows than a
    piece stays whole, so there may be fewer pieces; NULLs go with the first. The column should be a number.
    """
    at = [k / pieces for k in range(1, pieces)]
    found = df.agg(F.percentile_approx(column, at, pieces * 100).alias("at")).first()["at"] if at else None
    cuts = sorted(set(found or []))
    if not cuts:
        return ["1 = 1"]
    first = f"{column} <= {cuts[0]} OR {column} IS NULL"
    return [first, *(f"{column} > {a} AND {column} <= {b}" for a, b in zip(cuts, cuts[1:])), f"{column} > {cuts[-1]}"]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict | None = None) -> DataFrame:
    """A database table read by one task per condition, see ``range_predicates``."""
    return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": str(JDBC_FETCH_ROWS), **(properties or {})})


def read_ranges(df: DataFrame, predicates: list[str]) -> DataFrame:
    """The same of a stored table: one scan per range with the condition pushed down, each row marked with its ``piece``."""
    parts = [df.where(p).withColumn("piece", F.lit(i)) for i, p in enumerate(predicates)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def changed_since(df: DataFrame, cursor: datetime, column: str = "write_date", lookback: timedelta | None = None) -> DataFrame:
    """Rows written after the cursor.

    The cursor is a literal of the column's own type, so the filter reaches the scan. ``lookback`` re-reads a
    window before the cursor for rows that were committed late; the mirror absorbs the repeats.
    """
    since = cursor - lookback if lookback else cursor
    return df.where(F.col(column) > utc_literal(since, df.schema[column].dataType))


def utc_literal(moment: datetime, type_: T.DataType = T.TimestampType()) -> Column:
    """A naive moment counts as UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    text = moment.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(type_, T.TimestampNTZType):
        return F.lit(text).cast(type_)
    return F.lit(text + "+00:00").cast(T.TimestampType())


def in_utc(df: DataFrame) -> DataFrame:
    """Timestamps without a zone taken as UTC (the session's zone)."""
    naive = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive})


def raw_typed(df: DataFrame) -> DataFrame:
    """The loose raw-layer types: 64-bit integers, doubles, timestamps, flags, else text; all nullable."""

    def loose(t: T.DataType) -> str:
        if isinstance(t, T.IntegralType):
            return "bigint"
        if isinstance(t, T.NumericType):
            return "double"
        if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return "timestamp"
        return "boolean" if isinstance(t, T.BooleanType) else "string"

    return df.select(*[F.col(f.name).cast(loose(f.dataType)).alias(f.name) for f in df.schema])


# What an absent required value is stored as, by kind of type.
_DEFAULTS = {"string": "", "boolean": False}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns, order and types of the declared bronze table.

    A NULL in a column that bronze requires becomes the type's default; ids and timestamps have none and stay as they
    are, and columns that bronze lets be NULL stay NULL.
    """
    out = []
    for c in schema.columns(table):
        value = F.col(c.name).cast(c.type)
        if c.name in schema.BRONZE_REQUIRED[table] and c.type != "timestamp":
            value = F.coalesce(value, F.lit(_DEFAULTS.get(c.type, 0)).cast(c.type))
        out.append(value.alias(c.name))
    return df.select(*out)
