"""Declared schemas of the engine's own tables, their column defaults, and conforming to both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Table layouts and column defaults.
TABLES = {
    "contract_metadata": (
        "contract_id string, customer_name string, contract_type string, effective_date date, "
        "expiry_date date, file_name string, extraction_status string, "
        "extracted_at timestamp_ntz, created_at timestamp_ntz"
    ),
    "contract_pricing": (
        "contract_id string, customer_name string, service_type string, temperature string, "
        "container_size string, volume_tier_min int, volume_tier_max int, unit_price double, "
        "currency string, effective_date date, expiry_date date, extraction_method string, "
        "created_at timestamp_ntz"
    ),
    "billing_transactions": (
        "txn_id string, customer_name string, txn_date date, service_type string, "
        "temperature string, container_size string, quantity int, billed_unit_price double, "
        "total_amount double, erp_status string, reviewed_by string, "
        "reviewed_at timestamp_ntz, created_at timestamp_ntz"
    ),
    "contract_text": (
        "contract_id string, customer_name string, page_number int, section_title string, "
        "content string, created_at timestamp_ntz"
    ),
    "page_cache": (
        "filename string, customer_id string, page_index int, page_text string, "
        "total_pages int, parsed_at timestamp_ntz"
    ),
    "extracted_prices": (
        "filename string, region string, currency string, temperature string, "
        "sample_size string, quantity_tier string, price string, "
        "max_quantity_tier decimal(38,0), min_quantity_tier decimal(38,0), customer_id string, "
        "cubic_foot_max double, min_sample_size double, max_sample_size double, "
        "transaction_type string, extraction_method string, extracted_at timestamp_ntz"
    ),
    "extracted_fees": (
        "filename string, customer_id string, fee_category string, fee_name string, "
        "currency string, price string, unit string, description string, "
        "extraction_method string, extracted_at timestamp_ntz"
    ),
}
DEFAULTS = {
    "contract_metadata": {"extraction_status": "PENDING"},
    "contract_pricing": {"currency": "USD"},
    "billing_transactions": {"erp_status": "PRE_ERP"},
    "extracted_prices": {"transaction_type": "STORAGE"},
}
STAMPS = ("created_at", "parsed_at", "extracted_at")
# A contract gets its extraction time when it is extracted, not when it is registered.
UNSTAMPED = {("contract_metadata", "extracted_at")}


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the table's column order and types; absent columns get their default or NULL."""
    unknown = set(df.columns) - {f.name for f in empty_table(df.sparkSession, table).schema}
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    defaults = DEFAULTS.get(table, {})

    def column(name: str, kind: str) -> Column:
        if name in df.columns:
            value = F.col(name)
        elif name in STAMPS and (table, name) not in UNSTAMPED:
            value = F.current_timestamp()
        else:
            value = F.lit(defaults.get(name))
        return value.cast(kind).alias(name)

    fields = empty_table(df.sparkSession, table).schema.fields
    return df.select(*[column(f.name, f.dataType.simpleString()) for f in fields])
