"""Date keys and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """``20261204`` for a UTC timestamp or a date, by integer arithmetic rather than text formatting."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def iso_day_of_week(d: Column) -> Column:
    """Monday is 1."""
    return F.weekday(d) + 1


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def plus_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days.cast("int"))
