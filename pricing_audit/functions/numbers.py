"""Number handling that gives the same digits on every engine and under every partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def round_half(col: Column, digits: int) -> Column:
    """Round half away from zero through a decimal, so binary noise never decides a tie."""
    return F.round(col.try_cast("decimal(38,10)"), digits).cast("double")


def exact_sum(col: Column) -> Column:
    """Sum in decimal with ten places, so it does not depend on the order rows arrive in and keeps
    prices below a cent."""
    return F.sum(col.cast("decimal(28,10)")).cast("double")


def exact_avg(col: Column) -> Column:
    return round_half(exact_sum(col) / F.nullif(F.count(col), F.lit(0)), 6)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def text_to_double(col: Column) -> Column:
    """Plain numerals only: currency signs, thousands separators and type suffixes give NULL."""
    return F.when(col.rlike(NUMERIC_TEXT), F.trim(col).try_cast("double"))


def text_to_whole(col: Column) -> Column:
    """Whole number of up to 38 digits, halves rounded away from zero, NULL if not a numeral."""
    return F.when(col.rlike(NUMERIC_TEXT), F.trim(col).try_cast("decimal(38,0)"))


def text_to_date(col: Column) -> Column:
    return F.try_to_date(col, "yyyy-MM-dd")
