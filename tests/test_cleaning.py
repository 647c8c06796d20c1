from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarlake.functions import calendar, money, text


def apply(spark, rule, value, type_="string"):
    return spark.createDataFrame([(value,)], f"v {type_}").select(rule(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "rule, value, want",
    [
        (text.clean_name, "  mona   ALI ", "Mona Ali"),
        (text.clean_name, "o'neil-smith", "O'Neil-Smith"),
        (text.clean_name, "a\tb", "A B"),
        (text.clean_name, "6TH of october", "6th Of October"),
        (text.clean_name, "", ""),
        (text.clean_name, None, None),
        (text.clean_email, " A.B@X.com", "a.b@x.com"),
        (text.clean_email, "", None),
        (text.clean_email, "   ", None),
        (text.clean_email, None, None),
        (text.clean_city, "GIZA ", "giza"),
        (text.clean_street, " 5 El Haram St ", "5 El Haram St"),
        (text.clean_street, "   ", None),
        (text.clean_phone, "01012345678", "+201012345678"),
        (text.clean_phone, "+20 10 1234 5678", "+201012345678"),
        (text.clean_phone, "010-1234-5678", "+201012345678"),
        (text.clean_phone, "1012345678", "+201012345678"),
        (text.clean_phone, "02-12345678", None),
        (text.clean_phone, "abc", None),
        (text.clean_phone, "", None),
        (text.clean_phone, None, None),
    ],
)
def test_partner_text(spark, rule, value, want):
    assert apply(spark, rule, value) == want


def test_codes_are_padded_but_never_cut(spark):
    code = lambda c: text.padded_code("S", c, 8)
    assert apply(spark, code, 42, "bigint") == "S00000042"
    assert apply(spark, code, 123456789012, "bigint") == "S123456789012"


def test_variant_name(spark):
    rows = spark.createDataFrame([("T", None, None), ("T", "Red", None), ("T", None, "XL"), ("T", "Red", "XL")], "t string, c string, s string")
    got = [r[0] for r in rows.select(text.variant_name(F.col("t"), F.col("c"), F.col("s"))).collect()]
    assert got == ["T", "T - Red", "T / XL", "T - Red / XL"]


def test_date_key_keeps_the_utc_day(spark):
    assert apply(spark, calendar.date_key, datetime(2026, 12, 4, 23, 59, 59, 999900), "timestamp") == 20261204


def test_iso_day(spark):
    assert apply(spark, calendar.iso_day_of_week, date(2026, 12, 4), "date") == 5
    assert apply(spark, calendar.iso_day_of_week, date(2026, 12, 6), "date") == 7


def test_line_amounts_round_once(spark):
    df = spark.createDataFrame([(Decimal("3.000"), Decimal("19.99"), Decimal("12.50"))], "q decimal(12,3), p decimal(12,2), d decimal(5,2)")
    net, total = money.line_amounts(F.col("q"), F.col("p"), F.col("d"), F.expr("0.15BD"))
    row = df.select(net.alias("n"), total.alias("t")).first()
    assert (row["n"], row["t"]) == (Decimal("52.47"), Decimal("60.34"))


def test_stored_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.0500"), Decimal("0.0010"))], "a decimal(18,4), b decimal(18,4)")
    assert df.select(money.product(F.col("a"), F.col("b")).alias("r")).first()["r"] == Decimal("0.0001")
