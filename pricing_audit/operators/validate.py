"""Extracted prices against ground truth, and the match-rate summary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.domain import (
    FEE_BANDS,
    PRICE_BANDS,
    Bands,
    match_rate,
    match_status,
    quality_band,
)
from ..functions.numbers import round_half, safe_ratio, text_to_double
from .joins import lookup_join

PRICE_EXACT_KEYS = ("customer_id",)
PRICE_FOLDED_KEYS = ("temperature", "sample_size", "quantity_tier", "region")
FEE_EXACT_KEYS = ("customer_id",)
FEE_FOLDED_KEYS = ("fee_category", "fee_name")


def validate(
    extracted: DataFrame,
    truth: DataFrame,
    exact_keys: Sequence[str],
    folded_keys: Sequence[str],
    bands: Bands,
    limit: int | None = None,
) -> DataFrame:
    """Left join on exact keys and case-folded keys, then delta, percentage and match status."""
    folded = {f"__k_{k}": F.upper(k) for k in folded_keys}
    keys = [*exact_keys, *folded]
    expected = truth.select(
        *exact_keys, *[F.upper(k).alias(f"__k_{k}") for k in folded_keys],
        F.col("price").alias("expected_price"),
    )
    joined = lookup_join(
        extracted.withColumnRenamed("price", "extracted_price").withColumns(folded),
        expected, keys, limit=limit,
    )
    got, want = F.col("extracted_price_num"), F.col("expected_price_num")
    gap = F.abs(got - want)
    result = (
        joined.drop(*folded)
        .withColumns({
            "extracted_price_num": text_to_double(F.col("extracted_price")),
            "expected_price_num": text_to_double(F.col("expected_price")),
        })
        .withColumns({
            "price_delta": round_half(gap, 6),
            "price_delta_pct": round_half(safe_ratio(F.lit(100.0) * gap, want), 2),
        })
    )
    # The percentage rule looks at the rounded delta; the plain rule at the unrounded one.
    delta = F.col("price_delta") if bands.pct is not None else gap
    result = result.withColumn(
        "match_status",
        match_status(F.col("extracted_price"), F.col("expected_price"), delta,
                     F.col("price_delta_pct"), bands),
    )
    return result if bands.pct is not None else result.drop("price_delta_pct")


def validate_prices(extracted: DataFrame, truth: DataFrame, **options) -> DataFrame:
    return validate(
        extracted, truth, PRICE_EXACT_KEYS, PRICE_FOLDED_KEYS, PRICE_BANDS, **options
    )


def validate_fees(extracted: DataFrame, truth: DataFrame, **options) -> DataFrame:
    return validate(extracted, truth, FEE_EXACT_KEYS, FEE_FOLDED_KEYS, FEE_BANDS, **options)


def _stats(validated: DataFrame, table_type: str) -> DataFrame:
    status = F.col("match_status")
    return (
        validated.groupBy("customer_id", "extraction_method")
        .agg(
            F.count("*").alias("total_rows"),
            F.count_if(status.isin("EXACT_MATCH", "NEAR_MATCH")).alias("matched_rows"),
            F.count_if(status == "MISMATCH").alias("mismatched_rows"),
            F.count_if(status == "NO_EXPECTED").alias("no_expected_rows"),
        )
        .select("customer_id", "extraction_method", F.lit(table_type).alias("table_type"),
                "total_rows", "matched_rows", "mismatched_rows", "no_expected_rows")
    )


def validation_summary(**named: DataFrame) -> DataFrame:
    """One row per customer, method and named table, with match rate and quality band."""
    stats = reduce(DataFrame.unionByName, [_stats(df, name) for name, df in named.items()])
    rate = match_rate(F.col("matched_rows"), F.col("total_rows"), F.col("no_expected_rows"))
    return (
        stats.withColumn("match_rate_pct", rate)
        .withColumn("quality", quality_band(F.col("match_rate_pct")))
        .orderBy("customer_id", "table_type", "extraction_method")
    )
