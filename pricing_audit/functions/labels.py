"""Numbers hidden in tier and size labels, and identifiers hidden in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: upper bound written for an open-ended tier label.
OPEN_END = 999999999

_NUMBER = r"[0-9][0-9,]*(?:\.[0-9]+)?"


def _first_number(label: Column, pattern: str, group: int = 1) -> Column:
    digits = F.replace(F.regexp_extract(label, pattern, group), F.lit(","), F.lit(""))
    return digits.try_cast("double")


def label_bounds(label: Column) -> tuple[Column, Column]:
    """(lower, upper) of labels like ``5-10mL``, ``1-500,000``, ``>3,000,000``, ``<=4mL``, ``51+``.

    Labels without such a form give NULL for both.
    """
    above, upto = rf">\s*({_NUMBER})", rf"<=?\s*({_NUMBER})"
    span, plus = rf"({_NUMBER})\s*-\s*({_NUMBER})", rf"({_NUMBER})\s*\+"
    low = (
        F.when(label.rlike(above), _first_number(label, above))
        .when(label.rlike(upto), F.lit(0.0))
        .when(label.rlike(span), _first_number(label, span))
        .when(label.rlike(plus), _first_number(label, plus))
    )
    high = (
        F.when(label.rlike(above), F.lit(float(OPEN_END)))
        .when(label.rlike(upto), _first_number(label, upto))
        .when(label.rlike(span), _first_number(label, span, 2))
        .when(label.rlike(plus), F.lit(float(OPEN_END)))
    )
    return low, high


def customer_from_filename(filename: Column, suffix: str = ".pdf") -> Column:
    """Customer id derived from a file name: suffix dropped, blanks turned into underscores."""
    bare = F.replace(filename, F.lit(suffix), F.lit(""))
    return F.replace(bare, F.lit(" "), F.lit("_"))
