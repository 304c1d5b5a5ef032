"""From documents to result tables: parse once, extract, normalise, replace, report.

One call handles any number of documents and customers in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract, normalize, pages, runs
from ..operators.joins import lookup_join
from ..sources.tables import append_rows, read_if_exists, stage

Rules = Mapping[str, tuple[str, int] | Column]


@dataclass(frozen=True)
class Store:
    """Paths of the page cache, the two result tables and the run log."""

    root: str

    @property
    def pages(self) -> str:
        return f"{self.root}/pages"

    @property
    def prices(self) -> str:
        return f"{self.root}/prices"

    @property
    def fees(self) -> str:
        return f"{self.root}/fees"

    @property
    def log(self) -> str:
        return f"{self.root}/log"


@dataclass(frozen=True)
class Method:
    """How rows are extracted: A gives parallel arrays, B gives JSON text from a named model.

    For prices and fees alike, either rules or an extractor is given.
    """

    kind: str = "A"
    model: str | None = None
    price_rules: Rules | None = None
    fee_rules: Rules | None = None
    price_extractor: extract.Extractor | None = None
    fee_extractor: extract.Extractor | None = None

    def check(self) -> None:
        if self.kind not in ("A", "B"):
            raise ValueError(f"unknown method {self.kind!r}")
        if self.kind == "B":
            pages.check_model(self.model)


def extract_rates(
    docs: DataFrame, rules: Rules, dates: Mapping[str, tuple[str, int]],
    extractor: extract.Extractor | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The simple extraction: contract texts (contract_id, customer_name, service_type, text) to
    rate-card rows, rejected rows with their reason, and a status per contract.

    ``rules`` or an extractor give the rows as parallel arrays of ``extract.RATE_LINE_FIELDS``,
    ``dates`` the two dates that hold for a whole text. Missing tier bounds come from the tier
    label. A contract without any usable row is FAILED.
    """
    scalars = {
        name: F.nullif(F.regexp_extract("text", pattern, group), F.lit(""))
        for name, (pattern, group) in dates.items()
    }
    found = extract.extract_arrays(docs, rules, extractor, extract.RATE_LINE_FIELDS, "text")
    keep = ("contract_id", "customer_name", "service_type", *scalars)
    rows = extract.zip_flatten(
        extract.accepted(found).withColumns(scalars), "extraction", "temperature",
        extract.RATE_LINE_FIELDS, keep,
    )
    rates = normalize.normalize_rates(normalize.bounds_from_labels(rows), F.col("service_type"))
    rejects = normalize.rate_rejects(rates)
    usable = rates.dropna(subset=[
        "temperature", "container_size", "volume_tier_min", "volume_tier_max", "unit_price",
        "effective_date", "expiry_date",
    ])
    done = usable.groupBy("contract_id").agg(F.count("*").alias("rate_rows"))
    status = lookup_join(docs.select("contract_id").distinct(), done, ["contract_id"]).select(
        "contract_id", F.coalesce("rate_rows", F.lit(0)).alias("rate_rows"),
        F.when(F.col("rate_rows") > 0, "EXTRACTED").otherwise("FAILED").alias("status"),
    )
    return usable, rejects, status


def parse_documents(
    spark: SparkSession, docs: DataFrame, store: Store, lines_per_page: int = 5
) -> DataFrame:
    """Split documents not yet in the page cache, add them to it, and return the pages of all
    given documents (filename, customer_id, text).

    A file is parsed once however many customers share it (of several texts under one name the
    smallest by customer, then text); its pages are returned for each customer that names it.
    """
    cache = read_if_exists(spark, store.pages)
    first = F.min(F.struct("customer_id", "text")).alias("first")
    fresh = docs.groupBy("filename").agg(first).select("filename", "first.*")
    if cache is not None:
        fresh = pages.uncached(fresh, cache)
    append_rows(pages.split_pages(fresh, lines_per_page), store.pages)
    owners = docs.select("filename", "customer_id").distinct()
    cached = spark.read.parquet(store.pages).drop("customer_id")
    return lookup_join(cached, owners, ["filename"], "inner")


def _extracted_rows(
    page_rows: DataFrame, method: Method, words: tuple[str, ...], root: str, lead: str,
    fields: tuple[str, ...], required: str | None, rules: Rules | None,
    extractor: extract.Extractor | None, name: str,
) -> tuple[DataFrame, DataFrame]:
    chosen = pages.keyword_pages(page_rows, words)
    keep = ("filename", "customer_id")
    if method.kind == "A":
        done = stage(extract.extract_arrays(chosen, rules, extractor, fields), name)
        rows = extract.zip_flatten(extract.accepted(done), "extraction", lead, fields, keep)
        rows = rows.drop("row_index")
    else:
        done = stage(extract.extract_json(chosen, rules, extractor, root), name)
        rows = extract.flatten_rows(
            extract.accepted(done), "result_json", root, fields, keep, required)
    return rows, extract.rejected(done).select(*keep, "page_index", "error")


def _kept_rows(
    spark: SparkSession, path: str, errors: DataFrame, affected: DataFrame, keys: tuple[str, ...]
) -> DataFrame | None:
    """Earlier rows of the documents with failed pages, as far as this run would replace them."""
    if errors.isEmpty() or read_if_exists(spark, path) is None:
        return None
    failed = errors.select("filename", "customer_id").distinct()
    rows = lookup_join(runs.read_current(spark, path), failed, ["filename", "customer_id"], "left_semi")
    return lookup_join(rows, affected, list(keys), "left_semi")


def extract_contracts(
    spark: SparkSession, docs: DataFrame, store: Store, method: Method, run_id: int,
    lines_per_page: int = 5, by_file: bool = False,
) -> DataFrame:
    """Run one method over ``docs`` and replace its earlier results for the same customers, or with
    ``by_file`` only those of the same documents.

    Pages an extractor fails on are logged as FAILED with their reason. A failed document keeps the
    rows an earlier run stored for it; without earlier rows its other pages count. Returns the run
    report.
    """
    return extract_all(spark, docs, store, [method], run_id, lines_per_page, by_file)


def extract_all(
    spark: SparkSession, docs: DataFrame, store: Store, methods: Sequence[Method], run_id: int,
    lines_per_page: int = 5, by_file: bool = False,
) -> DataFrame:
    """All documents through several methods and models, as ``extract_contracts`` does for one. The
    page cache is read once; the report has a row per customer and method."""
    for method in methods:
        method.check()
    page_rows = parse_documents(spark, docs, store, lines_per_page)
    if len(methods) > 1:
        page_rows = stage(page_rows, "pages")
    reports = [
        _run_method(spark, docs, page_rows, store, method, run_id, by_file) for method in methods
    ]
    return reduce(DataFrame.unionByName, reports)


def _run_method(
    spark: SparkSession, docs: DataFrame, page_rows: DataFrame, store: Store, method: Method,
    run_id: int, by_file: bool,
) -> DataFrame:
    price_rows, price_errors = _extracted_rows(
        page_rows, method, pages.STORAGE_WORDS[method.kind], "storage_rows", "temperature",
        extract.PRICE_FIELDS, None, method.price_rules, method.price_extractor, "price-pages")
    fee_rows, fee_errors = _extracted_rows(
        page_rows, method, pages.FEE_WORDS[method.kind], "fee_rows", "fee_category",
        extract.FEE_FIELDS, "fee_name", method.fee_rules, method.fee_extractor, "fee-pages")
    prices = normalize.normalize_prices(price_rows, method.kind, method.model)
    fees = normalize.normalize_fees(fee_rows, method.kind, method.model)
    tag = normalize.method_tag(method.kind, method.model)
    keys = ("customer_id", "filename", "extraction_method") if by_file else runs.RESULT_KEYS
    affected = docs.withColumn("extraction_method", tag).select(*keys).distinct()
    for rows, errors, path in (
        (prices, price_errors, store.prices), (fees, fee_errors, store.fees)
    ):
        stamped = rows.withColumn("extracted_at", F.current_timestamp())
        kept = _kept_rows(spark, path, errors, affected, keys)
        if kept is not None:
            own = ["filename", "customer_id"]
            stamped = stage(
                lookup_join(stamped, kept.select(*own).distinct(), own, "left_anti")
                .unionByName(kept.select(*stamped.columns)), "kept",
            )
        runs.replace_keys(stamped, path, affected, keys, staged=True)

    failed = price_errors.unionByName(fee_errors).groupBy("filename").agg(
        F.count("*").alias("failed_pages"), F.min("error").alias("error"))
    outcome = lookup_join(
        docs.select("filename").distinct(), failed, ["filename"]
    ).select(
        F.col("filename").alias("contract_id"),
        F.when(F.col("failed_pages") > 0, "FAILED").otherwise("EXTRACTED").alias("status"),
        F.current_timestamp().alias("logged_at"),
        F.lit(run_id).cast("bigint").alias("run_id"),
        "failed_pages", "error",
    )
    append_rows(outcome, store.log)

    def written(path: str) -> DataFrame:
        rows = runs.read_current(spark, path).filter(F.col("extraction_method") == tag)
        customers = docs.select("customer_id").distinct()
        return lookup_join(rows, customers, ["customer_id"], "left_semi")

    return runs.run_report(page_rows, written(store.prices), written(store.fees))
