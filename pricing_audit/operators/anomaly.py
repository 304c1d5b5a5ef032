"""Billing against the rate card: rate lookup, price variance, classes and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.domain import (
    OVERCHARGE,
    REVIEWED_CLASSES,
    anomaly_class,
    two_sided_class,
    variance_pct,
)
from ..functions.numbers import exact_avg, exact_sum, round_half
from .joins import fits_broadcast, lookup_join
from .ranges import match_boxes

RATE_KEYS = ("customer_name", "service_type", "temperature", "container_size")

BILLING_COLUMNS = (
    "txn_id", "customer_name", "txn_date", "service_type", "temperature", "container_size",
    "quantity", "billed_unit_price", "total_amount", "erp_status",
)
CONTRACT_COLUMNS = (
    "contract_id", "contract_unit_price", "volume_tier_min", "volume_tier_max",
    "contract_start", "contract_end",
)


def _rate_side(rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rates.select(
        *keys,
        "contract_id",
        F.col("unit_price").alias("contract_unit_price"),
        "volume_tier_min",
        "volume_tier_max",
        F.col("effective_date").alias("contract_start"),
        F.col("expiry_date").alias("contract_end"),
    )


def match_rates(
    billing: DataFrame,
    rates: DataFrame,
    keys: Sequence[str] = RATE_KEYS,
    qty: str = "quantity",
    date: str | None = "txn_date",
    how: str = "left",
    single: bool = False,
    limit: int | None = None,
    cells: bool = False,
) -> DataFrame:
    """Attach the rate valid for each transaction's keys, quantity and date (closed ranges).

    Overlapping contracts give one row each. With ``single`` only the latest contract is kept; ties
    go to the smallest contract id. ``date=None`` ignores validity dates. ``cells`` looks rates up by
    dyadic cells of their ranges, for cards with very many versions per key; it takes whole
    quantities.
    """
    if single:
        return _match_single(billing, rates, keys, qty, date, how, limit, cells)
    if cells:
        ranges = [(qty, "volume_tier_min", "volume_tier_max")]
        if date is not None:
            ranges.append((date, "contract_start", "contract_end"))
        return match_boxes(billing, _rate_side(rates, keys), keys, ranges, how)
    condition = F.col(qty).between(F.col("volume_tier_min"), F.col("volume_tier_max"))
    if date is not None:
        condition &= F.col(date).between(F.col("contract_start"), F.col("contract_end"))
    return lookup_join(billing, _rate_side(rates, keys), keys, how, condition, limit)


def _match_single(billing, rates, keys, qty, date, how, limit, cells):
    side = _rate_side(rates, keys)
    if not cells and fits_broadcast(side, limit):
        return _first_candidate(billing, side, keys, qty, date, how)
    return _choice_per_signature(billing, rates, keys, qty, date, how, limit, cells)


def _first_candidate(billing, side, keys, qty, date, how):
    """Rates as one ordered list per key, broadcast; each transaction takes its first fit.

    No transaction is shuffled or repeated. The lists are bounded by the size check of the caller.
    """
    candidate = F.struct((-F.unix_date("contract_start")).alias("recency"), *CONTRACT_COLUMNS)
    lists = side.groupBy(*keys).agg(F.array_sort(F.collect_list(candidate)).alias("candidates"))

    def fits(rate):
        ok = F.col(qty).between(rate["volume_tier_min"], rate["volume_tier_max"])
        if date is not None:
            ok &= F.col(date).between(rate["contract_start"], rate["contract_end"])
        return ok

    joined = lookup_join(billing, lists, keys, how, small=True)
    picked = joined.withColumn("best", F.get(F.filter("candidates", fits), F.lit(0)))
    if how == "inner":
        picked = picked.filter(F.col("best").isNotNull())
    return picked.select(
        *billing.columns, *[F.col(f"best.{c}").alias(c) for c in CONTRACT_COLUMNS]
    )


def _ranked_contract():
    return F.struct((-F.unix_date("contract_start")).alias("recency"), *CONTRACT_COLUMNS)


def _first_of_equal_ranges(rates, keys, date):
    """Of rates that hold for the same transactions only the one that a choice would take, so that the
    pairs to choose from do not grow with amendments of the same range."""
    ranges = ["volume_tier_min", "volume_tier_max"] + (["contract_start", "contract_end"] if date else [])
    first = _rate_side(rates, keys).groupBy(*keys, *ranges).agg(F.min(_ranked_contract()).alias("best"))
    return first.select(
        *keys, "best.contract_id", F.col("best.contract_unit_price").alias("unit_price"),
        "volume_tier_min", "volume_tier_max", F.col("best.contract_start").alias("effective_date"),
        F.col("best.contract_end").alias("expiry_date"),
    )


def _choice_per_signature(billing, rates, keys, qty, date, how, limit, cells):
    """Choose once per distinct (keys, quantity, date), then attach the choice to all copies.

    Transactions need no unique id for this, and a combination shared by a third of all rows is
    one row by the time the choice is made.
    """
    signature = [*keys, qty] + ([date] if date else [])
    asked = billing.select(*signature).distinct()
    rates = _first_of_equal_ranges(rates, keys, date)
    matched = match_rates(asked, rates, keys, qty, date, "inner", limit=limit, cells=cells)
    ranked = _ranked_contract()
    chosen = matched.groupBy(*signature).agg(F.min(ranked).alias("best")).select(
        *signature, *[F.col(f"best.{c}").alias(c) for c in CONTRACT_COLUMNS]
    )
    # As many signatures as transactions are possible, so broadcasting is not considered.
    return lookup_join(billing, chosen, signature, how, small=False)


def with_variance(df: DataFrame) -> DataFrame:
    """Difference, percentage and revenue impact, each rounded from the unrounded inputs."""
    billed, agreed = F.col("billed_unit_price"), F.col("contract_unit_price")
    return df.withColumns({
        "price_difference": round_half(billed - agreed, 2),
        "price_variance_pct": round_half(variance_pct(billed, agreed), 2),
        "revenue_impact": round_half((billed - agreed) * F.col("quantity"), 2),
    })


def classify(df: DataFrame, tolerance_pct: float = 1.0, two_sided: bool = False) -> DataFrame:
    rule = two_sided_class if two_sided else anomaly_class
    return df.withColumn(
        "anomaly_type",
        rule(F.col("billed_unit_price"), F.col("contract_unit_price"), tolerance_pct),
    )


def billing_anomalies(
    billing: DataFrame, rates: DataFrame, tolerance_pct: float = 1.0, **match_options
) -> DataFrame:
    """Every transaction with its contract rate, variance, impact and class."""
    matched = match_rates(billing, rates, **match_options)
    classified = classify(with_variance(matched), tolerance_pct)
    return classified.select(
        *BILLING_COLUMNS, *CONTRACT_COLUMNS,
        "price_difference", "price_variance_pct", "revenue_impact", "anomaly_type",
    )


def amendment_feed(
    billing: DataFrame, rates: DataFrame, amendments: DataFrame, keys: Sequence[str] = RATE_KEYS,
    **options,
) -> DataFrame:
    """What ``amendments`` to ``rates`` change in the anomalies of ``billing``: anomaly rows with
    ``change``, positive for rows that come and negative for rows that go.

    Only transactions with an amended key are rated again. Added to the anomalies under the old card,
    the feed gives those under the whole one, in whatever order amendments arrive.
    """
    touched = lookup_join(billing, amendments.select(*keys).distinct(), keys, "left_semi")
    now = rates.unionByName(amendments)
    before = billing_anomalies(touched, rates, keys=keys, **options).withColumn("change", F.lit(-1))
    after = billing_anomalies(touched, now, keys=keys, **options).withColumn("change", F.lit(1))
    # Both sides are partitioned by the rate keys, but adaptive execution may cut them differently: a
    # shuffle of their own brings equal rows together.
    both = before.unionByName(after).repartition("txn_id")
    names = [c for c in both.columns if c != "change"]
    return both.groupBy(*names).agg(F.sum("change").alias("change")).filter("change <> 0")


def anomaly_summary(
    anomalies: DataFrame, by: Sequence[str] = ("customer_name", "anomaly_type")
) -> DataFrame:
    return anomalies.groupBy(*by).agg(
        F.count("*").alias("txn_count"),
        exact_sum(F.col("total_amount")).alias("total_billed"),
        exact_sum(F.col("revenue_impact")).alias("total_revenue_impact"),
        exact_avg(F.col("price_variance_pct")).alias("avg_variance_pct"),
        F.min("txn_date").alias("earliest_txn"),
        F.max("txn_date").alias("latest_txn"),
    )


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("anomaly_type").agg(F.count("*").alias("txn_count"))


def over_and_under(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter(F.col("anomaly_type").isin(*REVIEWED_CLASSES))


def top_anomalies(anomalies: DataFrame, k: int = 10) -> DataFrame:
    """The k largest impacts by size; ids break ties so the choice is repeatable."""
    return (
        over_and_under(anomalies)
        .select(
            "txn_id", "customer_name", "temperature", "container_size", "quantity",
            "billed_unit_price", "contract_unit_price", "price_difference", "revenue_impact",
            "anomaly_type", "contract_id",
        )
        .orderBy(F.abs("revenue_impact").desc(), "txn_id", "contract_id")
        .limit(k)
    )


def review_queue(anomalies: DataFrame) -> DataFrame:
    """Overcharges that can still be corrected before they reach the ledger."""
    return (
        anomalies.filter(
            (F.col("erp_status") == "PRE_ERP") & (F.col("anomaly_type") == OVERCHARGE)
        )
        .select(
            "txn_id", "customer_name", "txn_date", "temperature", "container_size", "quantity",
            "billed_unit_price", "contract_unit_price", "revenue_impact", "contract_id",
        )
        .orderBy(F.desc("revenue_impact"), "txn_id", "contract_id")
    )


def alerts(anomalies: DataFrame, threshold: float) -> DataFrame:
    """Transactions whose impact reaches the threshold in either direction."""
    return anomalies.filter(F.abs("revenue_impact") >= threshold)


def rate_history(rates: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Close each rate version the day before the next version of the same rate starts.

    Versions are compared by distinct start dates, so the window holds at most one row per calendar
    day however many contracts share a date.
    """
    keys = list(keys or (*RATE_KEYS, "volume_tier_min", "volume_tier_max"))
    starts = rates.select(*keys, "effective_date").distinct()
    following = F.lead("effective_date").over(Window.partitionBy(*keys).orderBy("effective_date"))
    starts = starts.select(*keys, "effective_date", following.alias("next_effective_date"))
    closed = F.least(F.col("expiry_date"), F.date_sub("next_effective_date", 1))
    return lookup_join(rates, starts, [*keys, "effective_date"]).withColumns({
        "closed_date": closed,
        "is_current": F.col("next_effective_date").isNull(),
    })
