"""Inline reference rows joined to stored tables on natural codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.operators.joins import skew_join


def literal_rows(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """A small relation written out in code; ``columns`` is a DDL string."""
    return spark.createDataFrame(list(rows), columns)


def with_governorate(rows: DataFrame, muhafazat: DataFrame, code: str = "mcode") -> DataFrame:
    """Replace a governorate code by the governorate's id."""
    gov = muhafazat.select(F.col("code").alias(code), F.col("id").alias("muhafaza_id"))
    return rows.join(gov, code).drop(code)


def with_city(rows: DataFrame, cities: DataFrame, row_key: str, city: str = "city_name") -> DataFrame:
    """Look the city id up by (governorate, city name); NULL where there is none."""
    known = cities.select(
        F.col("muhafaza_id").alias("_gov"), F.col("name").alias("_city_name"), F.col("id").alias("city_id")
    )
    found = skew_join(rows, known, [("muhafaza_id", "_gov"), (city, "_city_name")], [row_key], "left")
    return found.drop("_gov", "_city_name", city)
