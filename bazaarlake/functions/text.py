"""Cleaning rules for partner text and helpers for display strings. All built-in, code-generated expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks a word start inside a word for initcap; a control character never left in the result.
_WORD_START = "\u0001 "


def title_case(c: Column) -> Column:
    """Capital after every non-alphanumeric character, as in ``O'Neil-Smith``.

    Spark's ``initcap`` only starts a word after a blank, so a removable blank is put after each separator.
    """
    marked = F.regexp_replace(F.lower(c), r"([^\p{L}\p{N}])", "$1" + _WORD_START)
    return F.replace(F.initcap(marked), F.lit(_WORD_START), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def clean_name(c: Column) -> Column:
    return title_case(F.trim(F.regexp_replace(c, r"\s+", " ")))


def clean_email(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


clean_city = clean_email
clean_street = blank_to_null


def clean_phone(c: Column) -> Column:
    """``+20`` and ten digits from the three accepted national forms, else NULL."""
    digits = F.regexp_replace(c, r"\D", "")
    n = F.length(digits)
    return (
        F.when(digits.startswith("20") & (n == 12), F.concat(F.lit("+"), digits))
        .when(digits.startswith("0") & (n == 11), F.concat(F.lit("+20"), F.substring(digits, 2, 10)))
        .when(digits.startswith("1") & (n == 10), F.concat(F.lit("+20"), digits))
    )


def or_blank(c: Column) -> Column:
    """The warehouse stores '' where a join or source gives NULL for a required string."""
    return F.coalesce(c, F.lit(""))


def padded_code(prefix: str, number: Column, width: int) -> Column:
    """``S00000042``. Longer numbers keep all digits: ``lpad`` alone would cut them and make codes collide."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def variant_name(template: Column, color: Column, size: Column) -> Column:
    return F.concat(
        template,
        F.when(color.isNotNull(), F.concat(F.lit(" - "), color)).otherwise(""),
        F.when(size.isNotNull(), F.concat(F.lit(" / "), size)).otherwise(""),
    )


def category_path(parent: Column, child: Column) -> Column:
    return F.concat_ws(" / ", parent, child)
