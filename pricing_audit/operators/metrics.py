"""Metric layer: named facts and dimensions over one relation, plus the filter builder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.domain import ANOMALY_CLASSES, OVERCHARGE, REVIEWED_CLASSES
from ..functions.numbers import exact_avg, exact_sum

AGGREGATES = {
    "sum": exact_sum,
    "avg": exact_avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


@dataclass(frozen=True)
class MetricView:
    """A relation's vocabulary: facts with their default aggregate, and dimensions."""

    facts: Mapping[str, str]
    dimensions: Sequence[str]

    def check(self, facts: Sequence[str], dimensions: Sequence[str]) -> None:
        unknown = [f for f in facts if f not in self.facts]
        unknown += [d for d in dimensions if d not in self.dimensions]
        if unknown:
            raise KeyError(f"unknown facts or dimensions: {unknown}")


# The vocabulary of the two published relations.
RATE_VIEW = MetricView(
    facts={"unit_price": "avg", "volume_tier_min": "min", "volume_tier_max": "max"},
    dimensions=(
        "contract_id", "customer_name", "service_type", "temperature", "container_size",
        "effective_date", "expiry_date", "extraction_method",
    ),
)
ANOMALY_VIEW = MetricView(
    facts={
        "billed_unit_price": "avg", "total_amount": "sum", "quantity": "sum",
        "contract_unit_price": "avg", "price_difference": "sum", "price_variance_pct": "avg",
        "revenue_impact": "sum",
    },
    dimensions=(
        "txn_id", "customer_name", "txn_date", "service_type", "temperature", "container_size",
        "erp_status", "contract_id", "anomaly_type", "contract_start", "contract_end",
    ),
)


def metric_query(
    df: DataFrame,
    view: MetricView,
    dims: Sequence[str],
    facts: Sequence[str] | Mapping[str, str] = (),
    filters: Mapping[str, object] | None = None,
    order: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Chosen dimensions with aggregated facts: ``sum_revenue_impact`` and so on, and ``row_count``.

    ``facts`` may map a fact to another aggregate. ``order`` names output columns; a leading minus
    sorts descending. Unknown names raise.
    """
    chosen = dict(facts) if isinstance(facts, Mapping) else {f: view.facts.get(f) for f in facts}
    filters = filters or {}
    view.check(list(chosen), [*dims, *filters])
    measures = [
        AGGREGATES[how](F.col(fact)).alias(f"{how}_{fact}") for fact, how in chosen.items()
    ]
    result = (
        filtered(df, **filters)
        .groupBy(*dims)
        .agg(F.count("*").alias("row_count"), *measures)
    )
    if order:
        result = result.orderBy(*[
            F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name)
            for name in order
        ])
    return result if limit is None else result.limit(limit)


def filtered(df: DataFrame, **criteria: object) -> DataFrame:
    """AND of the given criteria; None or "All" skips one, a list means any of its values."""
    for name, value in criteria.items():
        if value is None or value == "All":
            continue
        many = isinstance(value, (list, tuple, set))
        column = F.col(name)
        df = df.filter(column.isin(*value) if many else column == value)
    return df


def by_status(df: DataFrame, preset: str = "MISMATCH") -> DataFrame:
    """Validation presets: only mismatches, everything with an expected value, or all rows."""
    if preset == "MISMATCH":
        return df.filter(F.col("match_status") == "MISMATCH")
    if preset == "All except NO_EXPECTED":
        return df.filter(F.col("match_status") != "NO_EXPECTED")
    if preset == "All":
        return df
    raise ValueError(f"unknown status preset {preset!r}")


def preview(df: DataFrame, order: Sequence[str | Column], limit: int = 500) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Sorted choices for each column as (column_name, value), from one pass over ``df``."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ])
    return (
        df.select(F.inline(pairs)).distinct().orderBy("column_name", "value")
    )


def customer_anomalies(anomalies: DataFrame, customer: str) -> DataFrame:
    return (
        anomalies.filter(
            (F.col("customer_name") == customer) & F.col("anomaly_type").isin(*REVIEWED_CLASSES)
        )
        .select(
            "txn_id", "txn_date", "temperature", "container_size", "quantity",
            "billed_unit_price", "contract_unit_price", "price_difference", "revenue_impact",
            "anomaly_type",
        )
        .orderBy("txn_date", "txn_id", "contract_unit_price")
    )


def overcharge_impact(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.filter(F.col("anomaly_type") == OVERCHARGE)
        .groupBy("customer_name")
        .agg(
            F.count("*").alias("overcharge_count"),
            exact_sum(F.col("revenue_impact")).alias("total_overcharge_impact"),
        )
        .orderBy(F.desc("total_overcharge_impact"), "customer_name")
    )


def rate_tiers(rates: DataFrame, temperature: str, container: str) -> DataFrame:
    return (
        rates.filter(
            (F.col("temperature") == temperature) & (F.col("container_size") == container)
        )
        .select(
            "customer_name", "contract_id", "service_type", "volume_tier_min", "volume_tier_max",
            "unit_price", "effective_date", "expiry_date",
        )
        .orderBy("customer_name", "volume_tier_min", "contract_id", "service_type")
    )


def billed_vs_contract(anomalies: DataFrame) -> DataFrame:
    """All transactions by size of deviation. The ids in the sort key keep equal deviations from
    piling up in one range partition."""
    return anomalies.select(
        "txn_id", "customer_name", "temperature", "container_size", "quantity",
        "billed_unit_price", "contract_unit_price", "price_difference", "price_variance_pct",
        "anomaly_type", "contract_id",
    ).orderBy(F.abs("price_variance_pct").desc_nulls_last(), "txn_id", "contract_id")


def anomaly_breakdown(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("customer_name", "anomaly_type")
        .agg(
            F.count("*").alias("txn_count"),
            exact_sum(F.col("revenue_impact")).alias("total_revenue_impact"),
            exact_avg(F.col("price_variance_pct")).alias("avg_variance_pct"),
        )
        .orderBy("customer_name", "anomaly_type")
    )


def anomaly_pivot(anomalies: DataFrame) -> DataFrame:
    """Chart feed: one row per customer, count and impact of each class side by side; rows without
    a class (both prices zero) stand under ``unclassified``."""
    classes = [*ANOMALY_CLASSES, "UNCLASSIFIED"]
    wide = (
        anomalies.withColumn("anomaly_type", F.coalesce("anomaly_type", F.lit("UNCLASSIFIED")))
        .groupBy("customer_name")
        .pivot("anomaly_type", classes)
        .agg(F.count(F.lit(1)).alias("count"), exact_sum(F.col("revenue_impact")).alias("impact"))
    )
    counts = {f"{c}_count": F.coalesce(F.col(f"{c}_count"), F.lit(0)) for c in classes}
    lowered = reduce(
        lambda df, name: df.withColumnRenamed(name, name.lower()), wide.columns,
        wide.withColumns(counts),
    )
    return lowered
