"""Extracted text rows to the two result tables: storage prices and fees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.domain import (
    DEFAULT_CURRENCY,
    currency_of,
    fee_price,
    region_or_default,
    regional_price,
)
from ..functions.labels import label_bounds
from ..functions.numbers import text_to_date, text_to_double, text_to_whole

# Method tags and row type.
METHOD_A = "AI_PARSE+AI_EXTRACT"
METHOD_B_PREFIX = "AI_PARSE+AI_COMPLETE_"
STORAGE = "STORAGE"


def method_tag(method: str, model: str | None = None) -> Column:
    if method == "A":
        return F.lit(METHOD_A)
    return F.concat(F.lit(METHOD_B_PREFIX), F.lit(model))


def normalize_prices(
    rows: DataFrame, method: str = "A", model: str = "mistral-large2",
    show_currency_used: bool = False,
) -> DataFrame:
    """Storage prices with region, currency and regional price chosen, bounds as numbers.

    Rows need a temperature and a USD price. ``show_currency_used`` adds the currency the price is
    really in, which differs from ``currency`` where the regional price was missing.
    """
    region, usd = F.col("region"), F.col("price_usd")
    price = regional_price(region, usd, F.col("price_eur"), F.col("price_sgd"), method)
    columns = [
        F.col("filename"),
        region_or_default(region).alias("region"),
        currency_of(region).alias("currency"),
        F.col("temperature"),
        F.col("sample_size_label").alias("sample_size"),
        F.col("qty_tier_label").alias("quantity_tier"),
        price.alias("price"),
        text_to_whole(F.col("max_qty")).alias("max_quantity_tier"),
        text_to_whole(F.col("min_qty")).alias("min_quantity_tier"),
        F.col("customer_id"),
        text_to_double(F.col("cubic_foot_max")).alias("cubic_foot_max"),
        text_to_double(F.col("min_sample_ml")).alias("min_sample_size"),
        text_to_double(F.col("max_sample_ml")).alias("max_sample_size"),
        F.lit(STORAGE).alias("transaction_type"),
        method_tag(method, model).alias("extraction_method"),
    ]
    if show_currency_used:
        no_default = regional_price(
            region, F.lit(None).cast("string"), F.col("price_eur"), F.col("price_sgd"), method
        )
        columns.append(
            F.when(no_default.isNotNull(), currency_of(region))
            .otherwise(DEFAULT_CURRENCY).alias("price_currency_actual")
        )
    return rows.filter(F.col("temperature").isNotNull() & usd.isNotNull()).select(*columns)


def normalize_fees(
    rows: DataFrame, method: str = "A", model: str = "mistral-large2"
) -> DataFrame:
    """Fee lines with the first available price; the currency is always the default one."""
    return rows.filter(F.col("fee_name").isNotNull()).select(
        "filename", "customer_id", "fee_category", "fee_name",
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        fee_price(F.col("price_usd"), F.col("price_eur"), F.col("price_sgd"), method)
        .alias("price"),
        "unit", "description",
        method_tag(method, model).alias("extraction_method"),
    )


def bounds_from_labels(rows: DataFrame, label: str = "tier_label") -> DataFrame:
    """Fill missing tier bounds from the tier's label."""
    low, high = label_bounds(F.col(label))
    return rows.withColumns({
        "volume_tier_min": F.coalesce("volume_tier_min", low.cast("bigint").cast("string")),
        "volume_tier_max": F.coalesce("volume_tier_max", high.cast("bigint").cast("string")),
    })


def rate_rejects(rates: DataFrame) -> DataFrame:
    """Rate-card rows that can't be used, with the first column that has no value as the reason."""
    needed = (
        "temperature", "container_size", "volume_tier_min", "volume_tier_max", "unit_price",
        "effective_date", "expiry_date",
    )
    reason = F.coalesce(*[F.when(F.col(c).isNull(), c) for c in needed])
    return rates.withColumn("reason", reason).filter("reason is not null")


def normalize_rates(
    rows: DataFrame, service_type: str | Column = "Biorepository Storage"
) -> DataFrame:
    """Rows of the simple extraction variant to rate-card rows, dates from text.

    Numbers and dates that can't be read become NULL; ``rate_rejects`` tells which rows those are.
    """
    return rows.select(
        "contract_id", "customer_name", F.lit(service_type).alias("service_type"),
        "temperature", "container_size",
        F.col("volume_tier_min").try_cast("int").alias("volume_tier_min"),
        F.col("volume_tier_max").try_cast("int").alias("volume_tier_max"),
        F.col("unit_price").try_cast("double").alias("unit_price"),
        text_to_date(F.col("effective_date")).alias("effective_date"),
        text_to_date(F.col("expiry_date")).alias("expiry_date"),
        F.lit("AI_EXTRACT").alias("extraction_method"),
    )
