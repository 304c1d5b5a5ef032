"""The anomaly summary kept current under additions and retractions.

What is kept per group and day are whole counts and decimal sums of signed rows, so a retraction undoes
its addition exactly, and the earliest and latest day are those whose count is not zero. The state is
as large as groups x days, whatever number of transactions it stands for; every batch writes the state
after it into one of two slots, so a replayed batch finds the state before it and replaces its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import round_half
from ..sources.tables import read_if_exists
from .jobs import _run

GROUPS = ("customer_name", "anomaly_type")
SUMMED = {"billed": "total_amount", "impact": "revenue_impact", "pct": "price_variance_pct"}


def day_parts(rows: DataFrame, by: Sequence[str] = GROUPS, day: str = "txn_date") -> DataFrame:
    """Signed counts and sums of anomaly rows per group and day; ``change`` says how often a row comes
    (negative: goes), once where there is no such column."""
    change = F.col("change").cast("long") if "change" in rows.columns else F.lit(1).cast("long")
    sums = []
    for name, column in SUMMED.items():
        value = F.col(column).cast("decimal(28,10)")
        # 28 + 9 digits: the product keeps all ten decimals.
        sums.append(F.sum((value * change.cast("decimal(9,0)")).cast("decimal(38,10)")).alias(name))
        sums.append(F.sum(F.when(value.isNotNull(), change).otherwise(0)).alias(f"n_{name}"))
    return rows.groupBy(*by, F.col(day).alias("day")).agg(F.sum(change).alias("n"), *sums)


def merged(parts: DataFrame, by: Sequence[str] = GROUPS) -> DataFrame:
    """Parts added up; days on which nothing is left are dropped."""
    names = ["n", *[f"{p}{x}" for x in SUMMED for p in ("", "n_")]]
    kinds = {x: "decimal(38,10)" for x in SUMMED}
    added = [F.sum(x).cast(kinds.get(x, "long")).alias(x) for x in names]
    return parts.groupBy(*by, "day").agg(*added).filter("n <> 0")


def summary(parts: DataFrame, by: Sequence[str] = GROUPS) -> DataFrame:
    """``anomaly_summary`` of the rows that the parts stand for."""

    def total(name: str):
        return F.when(F.sum(f"n_{name}") > 0, F.sum(name).cast("double"))

    return merged(parts, by).groupBy(*by).agg(
        F.sum("n").alias("txn_count"), total("billed").alias("total_billed"),
        total("impact").alias("total_revenue_impact"),
        round_half(total("pct") / F.nullif(F.sum("n_pct"), F.lit(0)), 6).alias("avg_variance_pct"),
        F.min("day").alias("earliest_txn"), F.max("day").alias("latest_txn"),
    )


def _state(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest state, or the newest one of an earlier batch than ``before``."""
    slots = read_if_exists(spark, path)
    if slots is None:
        return None
    if before is not None:
        slots = slots.filter(F.col("batch_id") < before)
    newest = slots.agg(F.max("batch_id").alias("b")).first()["b"]
    if newest is None:
        return None
    # By slot first: the folder that the next batch overwrites is then no part of the plan.
    return slots.filter((F.col("slot") == newest % 2) & (F.col("batch_id") == newest))


def stream_summary(
    anomalies: DataFrame, path: str, checkpoint: str, by: Sequence[str] = GROUPS,
    available_now: bool = True, every: str = "1 minute",
) -> StreamingQuery:
    """Arriving anomaly rows, signed by ``change`` if they have it, to the state under ``path``."""

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parts = day_parts(batch, by)
        # A state without rows must still be known as the newest: it has a mark.
        mark = parts.limit(0).unionByName(
            spark.range(1).select(F.lit(0).cast("long").alias("n")), allowMissingColumns=True
        )
        held = _state(spark, path, batch_id)
        if held is not None:
            parts = parts.unionByName(held.filter("not mark").select(parts.columns))
        rows = merged(parts, by).withColumn("mark", F.lit(False)).unionByName(
            mark.withColumn("mark", F.lit(True))
        )
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    return _run(anomalies, add, checkpoint, available_now, every)


def current_summary(spark: SparkSession, path: str, by: Sequence[str] = GROUPS) -> DataFrame:
    """The summary of all rows that have arrived and were not retracted."""
    held = _state(spark, path)
    if held is None:
        raise ValueError("nothing has arrived yet")
    return summary(held.filter("not mark"), by)
