"""Mirror column specs: every source column typed for the mirror, partner text cleaned."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import schema
from bazaarlake.functions import text

CLEANING: dict[str, dict[str, Callable[[Column], Column]]] = {
    "res_partner": {
        "name": text.clean_name,
        "email": text.clean_email,
        "phone": text.clean_phone,
        "street": text.clean_street,
        "city": text.clean_city,
    }
}


def mirror_select(df: DataFrame, table: str) -> DataFrame:
    """The table's rows as the mirror stores them, in one projection."""
    rules = CLEANING.get(table, {})
    return df.select(
        *[
            rules.get(c.name, lambda col: col)(F.col(c.name)).cast(c.mirror_type).alias(c.name)
            for c in schema.columns(table)
        ]
    )


class Silver:
    """The mirrored tables of a source, one row per id. ``overrides`` replaces single tables."""

    def __init__(self, source, **overrides: DataFrame):
        self._source = source
        self._overrides = overrides

    def __call__(self, table: str) -> DataFrame:
        if table in self._overrides:
            return self._overrides[table]
        return mirror_select(self._source.table(table), table)
