"""Event-time windows over rows (keys, at, value): sliding sums, and sessions that join storms of alerts.

Times are whole numbers of any unit. A window's rows are kept as parts (keys, first, last, rows, total)
that can be added up in any grouping: batch jobs merge the parts of all rows, streams those of a batch
with what was open before. Values are added as decimals, so the order of arrival does not show.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = ("first", "last", "rows", "total")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    seconds = (
        F.unix_date(ts.cast("date")).cast("decimal(20,6)") * 86400
        + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.date_part(F.lit("SECOND"), ts)
    )
    return (seconds * 1_000_000).cast("long")


def _added(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"),
        F.sum("total").cast("decimal(38,10)").alias("total"),
    )


def _single() -> list[Column]:
    return [
        F.col("at").cast("long").alias("first"), F.col("at").cast("long").alias("last"),
        F.lit(1).cast("long").alias("rows"),
        F.coalesce(F.col("value").cast("decimal(28,10)"), F.lit(0)).cast("decimal(38,10)").alias("total"),
    ]


@dataclass(frozen=True)
class Sliding:
    """Windows of ``width`` that begin at every multiple of ``slide``, of which width is a multiple.
    A window is [begin, begin + width)."""

    keys: tuple[str, ...]
    width: int
    slide: int

    def __post_init__(self):
        if self.slide <= 0 or self.width <= 0 or self.width % self.slide:
            raise ValueError("the width must be a multiple of the slide")

    @property
    def by(self) -> list[str]:
        return [*self.keys, "begin"]

    @property
    def columns(self) -> list[str]:
        return [*self.by, *PART]

    def parts(self, rows: DataFrame) -> DataFrame:
        """One part per key and slide; a row is copied to the windows only once it is added up."""
        begin = (F.col("at") - F.pmod("at", F.lit(self.slide))).cast("long").alias("begin")
        slides = _added(rows.filter("at is not null").select(*self.keys, begin, *_single()), [*self.keys, "begin"])
        copies = F.sequence(F.col("begin") - (self.width - self.slide), F.col("begin"), F.lit(self.slide))
        return slides.select(*self.keys, F.explode(copies).alias("begin"), *PART)

    def merge(self, parts: DataFrame) -> DataFrame:
        return _added(parts, [*self.keys, "begin"]).select(*self.columns)

    def end(self) -> Column:
        return F.col("begin") + self.width


@dataclass(frozen=True)
class Sessions:
    """Rows of a key of which each follows the one before by less than ``gap``.

    Rows are added up per stretch of ``gap`` first (they are of one session), so the ordered window sees
    a row per key and stretch at most, however many rows a storm has.
    """

    keys: tuple[str, ...]
    gap: int

    def __post_init__(self):
        if self.gap <= 0:
            raise ValueError("the gap must be positive")

    @property
    def by(self) -> list[str]:
        return [*self.keys]

    @property
    def columns(self) -> list[str]:
        return [*self.by, *PART]

    def parts(self, rows: DataFrame) -> DataFrame:
        stretch = (F.col("at") - F.pmod("at", F.lit(self.gap))).alias("stretch")
        single = rows.filter("at is not null").select(*self.keys, stretch, *_single())
        return _added(single, [*self.keys, "stretch"]).select(*self.columns)

    def merge(self, parts: DataFrame) -> DataFrame:
        by_key = Window.partitionBy(*self.keys).orderBy("first", "last")
        earlier = F.max("last").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
        opens = F.coalesce((F.col("first") >= earlier + self.gap).cast("int"), F.lit(1))
        marked = parts.select(*self.columns).withColumn("opens", opens)
        number = F.sum("opens").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
        numbered = marked.withColumn("session", number)
        return _added(numbered, [*self.keys, "session"]).select(*self.columns)

    def end(self) -> Column:
        return F.col("last") + self.gap


Kind = Sliding | Sessions


def event_windows(rows: DataFrame, kind: Kind) -> DataFrame:
    """All windows of ``rows`` (keys, at, value). Rows without a time are in none, a null value adds
    nothing to the total, null keys are a key of their own."""
    return kind.merge(kind.parts(rows))
