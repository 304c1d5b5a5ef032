"""Pipeline runs: keyed replacement of results, status log, run report, several methods at once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import stage
from .joins import lookup_join

RESULT_KEYS = ("customer_id", "extraction_method")
_EMPTY = "is_empty_mark"


def replace_keys(
    df: DataFrame, path: str, affected: DataFrame, keys: Sequence[str] = RESULT_KEYS,
    staged: bool = False,
) -> None:
    """Replace all rows of the affected keys in one write; safe to run again.

    ``affected`` lists the keys this run processed. A key that produced no rows gets a single mark
    row in its partition, which replaces what was there; ``read_current`` hides the marks. Rows of a
    key outside ``affected`` would replace results this run knows nothing of, so they are refused
    before anything is written. The rows
    are staged first, so an expensive extraction behind them runs once; ``staged`` says they already
    come from such a place. They are rebalanced by key before writing, which also splits a key too
    large for one task.
    """
    keys = list(keys)
    if not staged:
        df = stage(df, "replace")
    affected = affected.select(*keys).distinct()
    stray = lookup_join(df.select(*keys), affected, keys, "left_anti").limit(1).collect()
    if stray:
        raise ValueError(f"rows of a key that is not affected: {stray[0].asDict()}")
    payload = [F.lit(None).cast(f.dataType).alias(f.name)
               for f in df.schema.fields if f.name not in keys]
    vacant = lookup_join(
        affected, df.select(*keys).distinct(), keys, "left_anti"
    )
    marks = vacant.select(*keys, *payload, F.lit(True).alias(_EMPTY))
    rows = df.withColumn(_EMPTY, F.lit(False)).unionByName(marks)
    (
        rows.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def read_current(
    spark: SparkSession, path: str, keys: Sequence[str] = (*RESULT_KEYS, "filename")
) -> DataFrame:
    """The stored rows without marks. ``keys`` are text, also where they name folders whose values
    look like numbers or dates."""
    found = spark.read.parquet(path).schema
    text = [T.StructField(f.name, T.StringType() if f.name in keys else f.dataType) for f in found.fields]
    return spark.read.schema(T.StructType(text)).parquet(path).filter(~F.col(_EMPTY)).drop(_EMPTY)


def contract_status(run_log: DataFrame) -> DataFrame:
    """Latest status per contract from an append-only log (contract_id, status, logged_at, run_id).

    The last run id breaks ties between entries of the same time.
    """
    order = F.struct("logged_at", "run_id")
    return run_log.groupBy("contract_id").agg(
        F.max_by("status", order).alias("extraction_status"),
        F.max(F.when(F.col("status") == "EXTRACTED", F.col("logged_at"))).alias("extracted_at"),
        F.count("*").alias("log_entries"),
    )


def method_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*RESULT_KEYS).agg(F.count("*").alias("row_count"))


def run_report(pages: DataFrame, prices: DataFrame, fees: DataFrame) -> DataFrame:
    """Pages, price rows and fee rows per customer and method.

    Each input is reduced to counts first; only the small count relations meet.
    """
    zero = F.lit(0).cast("bigint")
    parts = [
        method_counts(prices).select(
            *RESULT_KEYS, F.col("row_count").alias("storage_rows"), zero.alias("fee_rows")),
        method_counts(fees).select(
            *RESULT_KEYS, zero.alias("storage_rows"), F.col("row_count").alias("fee_rows")),
    ]
    per_method = reduce(DataFrame.unionByName, parts).groupBy(*RESULT_KEYS).agg(
        F.sum("storage_rows").alias("storage_rows"), F.sum("fee_rows").alias("fee_rows")
    )
    page_counts = pages.groupBy("customer_id").agg(F.count("*").alias("pages"))
    joined = lookup_join(per_method, page_counts, ["customer_id"])
    return joined.select(
        *RESULT_KEYS, F.coalesce("pages", F.lit(0)).alias("pages"), "storage_rows", "fee_rows"
    )


def run_methods(
    pages: DataFrame, methods: Mapping[str, Callable[[DataFrame], DataFrame]]
) -> DataFrame:
    """All documents through every method in one job; results are tagged by the method functions."""
    return reduce(DataFrame.unionByName, [extract(pages) for extract in methods.values()])
