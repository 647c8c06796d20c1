"""Unions of many frames, and line amounts rolled up to their headers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name, paired up as a balanced tree: a chain would be analysed again from the start at each step."""
    level = list(frames)
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return level[0]


def line_totals(lines: DataFrame, header_key: str = "order_id") -> DataFrame:
    return lines.groupBy(F.col(header_key).alias("_header")).agg(
        F.sum("price_subtotal").cast("decimal(14,2)").alias("_net"),
        F.sum("price_total").cast("decimal(14,2)").alias("_total"),
    )


def rollup_totals(headers: DataFrame, lines: DataFrame, header_key: str = "order_id") -> DataFrame:
    """Set the amounts of each header that has lines; a header without lines keeps its own.

    The lines are summed before the join, with partial sums on the map side, so a header with very many lines
    is no special case and the join is one row to one row.
    """
    totals = line_totals(lines, header_key)
    amounts = {
        "amount_untaxed": F.col("_net"),
        "amount_tax": (F.col("_total") - F.col("_net")).cast("decimal(14,2)"),
        "amount_total": F.col("_total"),
    }
    joined = headers.join(totals, F.col("id") == F.col("_header"), "left")
    return joined.withColumns({c: F.coalesce(v, F.col(c)) for c, v in amounts.items()}).drop(
        "_header", "_net", "_total"
    )
