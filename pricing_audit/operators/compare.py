"""One extraction method against another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.domain import compare_status
from .joins import lookup_join

PRICE_KEYS = ("customer_id", "temperature", "sample_size", "quantity_tier", "region")
PRICE_KEYS_NO_REGION = PRICE_KEYS[:-1]
FEE_KEYS = ("customer_id", "fee_category", "fee_name")


def compare_methods(
    rows: DataFrame,
    keys: Sequence[str],
    left: str,
    right: str,
    how: str = "left",
    missing: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Prices of two methods side by side with a status.

    Both sides are cut to their method before the join. ``how="full"`` also shows rows only the
    right method found, as A_MISSING; ``missing=False`` folds absent right prices into DIFF.
    """
    if how not in ("left", "full"):
        raise ValueError(f"unsupported comparison {how!r}")
    method = F.col("extraction_method")
    a = rows.filter(method == left).select(*keys, F.col("price").alias("price_a"))
    b = rows.filter(method == right).select(*keys, F.col("price").alias("price_b"))
    compared = lookup_join(a, b, keys, limit=limit).withColumn(
        "status", compare_status(F.col("price_a"), F.col("price_b"), missing)
    )
    if how == "full":
        only_b = lookup_join(b, a.select(*keys).distinct(), keys, "left_anti", limit=limit)
        compared = compared.unionByName(
            only_b.select(*keys, F.lit(None).cast("string").alias("price_a"), "price_b",
                          F.lit("A_MISSING").alias("status"))
        )
    return compared


def compare_tally(compared: DataFrame) -> DataFrame:
    """Counts per status over the whole relation and the floored match percentage."""
    status = F.col("status")
    counted = compared.agg(
        F.count("*").alias("total"),
        F.count_if(status == "MATCH").alias("matched"),
        F.count_if(status == "DIFF").alias("diff"),
        F.count_if(status == "B_MISSING").alias("b_missing"),
    )
    share = F.floor(F.lit(100) * F.col("matched") / F.nullif(F.col("total"), F.lit(0)))
    return counted.withColumn("match_pct", F.coalesce(share, F.lit(0)).cast("bigint"))
