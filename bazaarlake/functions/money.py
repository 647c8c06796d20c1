"""Exact money arithmetic. Everything is decimal; results are cast back to the stored scale (HALF_UP)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STORED = "decimal(18,4)"


def stored(c: Column) -> Column:
    return c.cast(STORED)


def difference(a: Column, b: Column) -> Column:
    return stored(a - b)


def product(a: Column, b: Column) -> Column:
    return stored(a * b)


def percent_factor(percent: Column) -> Column:
    """``1 - percent/100`` without a division, so no digits are lost."""
    return (F.lit(1) - percent.cast("decimal(5,2)") * F.expr("0.01BD")).cast("decimal(5,4)")


def line_amounts(qty: Column, price: Column, discount: Column, tax_rate: Column) -> tuple[Column, Column]:
    """Net and taxed amount of a line, each rounded to cents from the unrounded product.

    The factors are kept narrow so that the full product fits 38 digits and is exact.
    """
    net = qty.cast("decimal(12,3)") * price.cast("decimal(12,2)") * percent_factor(discount)
    taxed = net * (F.lit(1) + tax_rate.cast("decimal(3,2)")).cast("decimal(4,2)")
    return F.round(net, 2).cast("decimal(14,2)"), F.round(taxed, 2).cast("decimal(14,2)")
