"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import customer_from_filename, label_bounds
from ..functions.numbers import exact_sum
from ..operators import (
    anomaly, compare, extract, ivf, layout, lifecycle, metrics, normalize, pages, runs, search, segments, semantic,
    validate, windows,
)
from ..session import scratch_path
from ..sources import documents, tables, testdata
from ..streaming import event_time, jobs, summaries, versions
from ..streaming import lifecycle as lifecycle_stream
from . import contracts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries, shared with the oracle.
PARSED_AT = "2025-01-01 00:00:00"
KEYWORDS = ("license", "token", "mail")
LINK = r'<a href="([^"]*)">([^<]*)</a>'


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _anomalies(spark: SparkSession, sf: str, **options) -> DataFrame:
    return anomaly.billing_anomalies(
        testdata.billing(spark, sf), testdata.rate_card(spark, sf), **options
    )


def _part(spark: SparkSession, sf: str) -> DataFrame:
    return testdata.table(spark, sf, "part")


def _parsed_at():
    return F.lit(PARSED_AT).cast("timestamp_ntz")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.spread(testdata.document_rows(spark, sf))
    return pages.split_pages(docs, parsed_at=_parsed_at())


def _fees(spark: SparkSession, sf: str) -> DataFrame:
    """Fee rows of two methods; method B overlooks gears and misreads bolts."""
    fees = normalize.normalize_fees(testdata.raw_fee_rows(_part(spark, sf)))
    b = (
        fees.filter(~F.col("fee_name").contains("gear"))
        .withColumn("price", F.when(F.col("fee_name").contains("bolt"), "1.00")
                    .otherwise(F.col("price")))
        .withColumn("extraction_method", F.lit("B"))
    )
    return fees.withColumn("extraction_method", F.lit("A")).unionByName(b)


# --- billing against the rate card ---------------------------------------------------------------

@query
def billing_anomalies(spark, sf):
    return _anomalies(spark, sf)


@query
def billing_anomalies_single_match(spark, sf):
    return _anomalies(spark, sf, single=True)


@query
def anomaly_inner_variant(spark, sf):
    matched = anomaly.match_rates(
        testdata.billing(spark, sf).drop("service_type"), testdata.rate_card(spark, sf),
        keys=("customer_name", "temperature", "container_size"), date=None, how="inner",
    )
    flagged = anomaly.classify(anomaly.with_variance(matched), two_sided=True)
    return flagged.groupBy("customer_name", "anomaly_type").agg(
        F.count("*").alias("pair_count"),
        exact_sum(F.col("revenue_impact")).alias("total_revenue_impact"),
    )


@query
def anomaly_summary(spark, sf):
    return anomaly.anomaly_summary(_anomalies(spark, sf))


@query
def anomaly_counts(spark, sf):
    return anomaly.anomaly_counts(_anomalies(spark, sf)).orderBy("anomaly_type")


@query
def anomaly_summary_reviewed(spark, sf):
    summary = anomaly.anomaly_summary(anomaly.over_and_under(_anomalies(spark, sf)))
    return summary.select(
        "customer_name", "anomaly_type", "txn_count", "total_revenue_impact"
    ).orderBy("customer_name", "anomaly_type")


@query
def top_anomalies(spark, sf):
    return anomaly.top_anomalies(_anomalies(spark, sf))


@query
def impact_alerts(spark, sf):
    return anomaly.alerts(_anomalies(spark, sf), 5000.0).select(
        "txn_id", "contract_id", "customer_name", "revenue_impact", "anomaly_type"
    )


@query
def rate_history(spark, sf):
    return anomaly.rate_history(testdata.rate_card(spark, sf))


VERSION_KEYS = ("customer_name", "service_type")


@query
def rates_of_many_versions(spark, sf):
    """Shipments with every amendment that holds for them, by cells of the ranges."""
    matched = anomaly.match_rates(
        testdata.shipments(spark, sf), testdata.amendments(spark, sf), VERSION_KEYS, cells=True
    )
    return matched.select("txn_id", "contract_id", "contract_unit_price")


@query
def latest_of_many_versions(spark, sf):
    """Each shipment with its latest amendment."""
    matched = anomaly.match_rates(
        testdata.shipments(spark, sf), testdata.amendments(spark, sf), VERSION_KEYS, single=True, cells=True
    )
    return matched.select("txn_id", "contract_id", "contract_unit_price", "contract_start")


# --- metric layer --------------------------------------------------------------------------------

@query
def overcharge_impact_by_customer(spark, sf):
    return metrics.overcharge_impact(_anomalies(spark, sf))


@query
def customer_anomalies(spark, sf):
    return metrics.customer_anomalies(_anomalies(spark, sf), "BUILDING")


@query
def rate_tiers_for_item(spark, sf):
    return metrics.rate_tiers(testdata.rate_card(spark, sf), "Brand#7", "SMALL")


@query
def billed_vs_contract(spark, sf):
    return metrics.billed_vs_contract(_anomalies(spark, sf))


@query
def anomaly_breakdown(spark, sf):
    return metrics.anomaly_breakdown(_anomalies(spark, sf))


@query
def pre_invoice_overcharges(spark, sf):
    return anomaly.review_queue(_anomalies(spark, sf))


@query
def anomaly_pivot(spark, sf):
    return metrics.anomaly_pivot(_anomalies(spark, sf))


@query
def metric_query_sample(spark, sf):
    return metrics.metric_query(
        _anomalies(spark, sf), metrics.ANOMALY_VIEW,
        dims=("erp_status", "container_size"),
        facts=("revenue_impact", "total_amount", "price_variance_pct"),
        filters={"anomaly_type": ["OVERCHARGE", "UNDERCHARGE"]},
        order=("-sum_revenue_impact", "erp_status", "container_size"),
    )


@query
def metric_query_rates(spark, sf):
    return metrics.metric_query(
        testdata.rate_card(spark, sf), metrics.RATE_VIEW,
        dims=("customer_name", "temperature"),
        facts={"unit_price": "max", "volume_tier_min": "min", "volume_tier_max": "max"},
        filters={"container_size": "LARGE"},
        order=("customer_name", "temperature"),
    )


@query
def metric_query_small_prices(spark, sf):
    """Averages of unit prices with four decimals."""
    price = (F.col("p_retailprice") / 1000).cast("decimal(18,4)").cast("double")
    rates = _part(spark, sf).select(F.col("p_brand").alias("temperature"), price.alias("unit_price"))
    return metrics.metric_query(rates, metrics.RATE_VIEW, ["temperature"], ["unit_price"])


@query
def filtered_prices(spark, sf):
    rows = metrics.filtered(
        testdata.extracted_prices(spark, sf),
        customer_id="BUILDING", extraction_method="A", temperature=None, region="All",
    )
    return metrics.preview(
        rows.select("customer_id", "filename", "temperature", "sample_size", "quantity_tier",
                    "region", "price", "min_quantity_tier", "max_quantity_tier",
                    "extraction_method"),
        ["customer_id", "temperature", "sample_size", "min_quantity_tier"],
    )


@query
def fee_previews(spark, sf):
    fees = metrics.filtered(_fees(spark, sf), extraction_method="A", fee_category="All")
    return metrics.preview(
        fees.select("customer_id", "fee_category", "fee_name", "price", "unit",
                    F.left("description", F.lit(8)).alias("description")),
        ["customer_id", "fee_category", "fee_name"], 200,
    )


@query
def distinct_filter_values(spark, sf):
    return metrics.distinct_values(
        testdata.extracted_prices(spark, sf), "extraction_method", "temperature", "region"
    )


# --- pages and extraction ------------------------------------------------------------------------

@query
def split_pages(spark, sf):
    return _pages(spark, sf).select(
        "filename", "customer_id", "page_index", "page_text", "total_pages"
    )


@query
def split_html_pages(spark, sf):
    docs = tables.spread(testdata.table(spark, sf, "pages").select(
        F.col("url").alias("filename"), F.lit("web").alias("customer_id"), "html"
    ))
    return pages.split_html_pages(docs, parsed_at=_parsed_at()).select(
        "filename", "page_index", "page_text", "total_pages"
    )


@query
def page_cache_status(spark, sf):
    return pages.page_cache_status(_pages(spark, sf)).orderBy("filename")


@query
def parse_once_delta(spark, sf):
    """The cache holds the labelled documents; all others still have to be split."""
    docs = testdata.document_rows(spark, sf)
    labelled = testdata.table(spark, sf, "labels").select("doc_id").distinct()
    cache = docs.join(labelled, "doc_id", "left_semi").select("filename")
    fresh = pages.split_pages(pages.uncached(docs, cache), parsed_at=_parsed_at())
    return fresh.select("filename", "customer_id", "page_index", "total_pages")


@query
def keyword_pages(spark, sf):
    return pages.keyword_pages(_pages(spark, sf), KEYWORDS).select(
        "filename", "page_index", "page_text"
    )


@query
def token_budget(spark, sf):
    return pages.with_token_budget(_pages(spark, sf), 400).select(
        "filename", "page_index", "tokens", "fits"
    )


@query
def batch_customer_ids(spark, sf):
    docs = testdata.table(spark, sf, "documents")
    name = F.concat(F.lit("rate card "), F.col("lang"), F.lit(" "), F.col("source"), F.lit(".pdf"))
    return docs.select("doc_id", customer_from_filename(name).alias("customer_id"))


@query
def extract_parallel_arrays(spark, sf):
    rules = {"href": (LINK, 1), "label": (LINK, 2)}
    extracted = extract.extract_arrays(
        testdata.table(spark, sf, "pages"), rules, text="html"
    )
    return extract.zip_flatten(
        extracted, "extraction", "href", ("href", "label"), keep=("page_id",)
    )


@query
def ragged_array_flatten(spark, sf):
    """Lead: lines of a turn; second array: its sentences, longer or shorter; some are empty."""
    turns = testdata.table(spark, sf, "conversations")
    arrays = turns.select(
        "conv_id", "turn",
        F.struct(
            F.when(F.col("role") != "system", F.split("text", "\n")).alias("line"),
            F.split("text", r"\. ").alias("sentence"),
        ).alias("parts"),
    )
    return extract.zip_flatten(
        arrays, "parts", "line", ("line", "sentence"), keep=("conv_id", "turn")
    )


def _document_json(spark, sf):
    """Two fee rows per document as JSON text; some malformed, some with an explicit null name."""
    docs = testdata.table(spark, sf, "documents")
    name = F.when(F.col("doc_id") % 13 == 0, "null").otherwise(
        F.concat(F.lit('"'), F.col("source"), F.lit('"'))
    )
    text = F.concat(
        F.lit('{"rows":[{"fee_category":"'), F.col("lang"), F.lit('","fee_name":'), name,
        F.lit(',"price_usd":'), F.col("n_chars").cast("string"),
        F.lit('},{"fee_category":"'), F.col("lang"),
        F.lit('","fee_name":"second","price_usd":"'), F.col("doc_id").cast("string"),
        F.lit('","unit":"per page"}]}'),
    )
    cut = F.when(F.col("doc_id") % 17 == 0, F.left(text, F.length(text) - 1)).otherwise(text)
    return docs.select("doc_id", cut.alias("result_json"))


@query
def extract_json_rows(spark, sf):
    return extract.flatten_rows(
        _document_json(spark, sf), "result_json", "rows",
        ("fee_category", "fee_name", "price_usd", "unit"), keep=("doc_id",), required="fee_name",
    )


@query
def extract_json_from_rules(spark, sf):
    """Links of each web page as JSON text, then back to rows."""
    made = extract.extract_json(
        testdata.table(spark, sf, "pages"), {"href": (LINK, 1), "label": (LINK, 2)},
        root="links", text="html",
    )
    return extract.flatten_rows(made, "result_json", "links", ("href", "label"), keep=("page_id",))


@query
def safe_json_props(spark, sf):
    events = testdata.table(spark, sf, "events")
    cut = F.when(
        F.col("event_id") % 17 == 0, F.left("props", F.length("props") - 1)
    ).otherwise(F.col("props"))
    parsed = events.select("event_id", "event_type", cut.alias("props"))
    return (
        parsed.select("event_id", "event_type",
                      extract.json_path("props", "$.k", "int").alias("k"))
        .filter(F.col("k").isNotNull())
    )


@query
def label_bounds_of_tiers(spark, sf):
    size, number = F.col("p_size"), F.col("p_partkey")
    big = F.format_number(size * 1000, 0)
    label = (
        F.when(number % 7 == 0, F.concat(F.lit("<="), size, F.lit(".4mL")))
        .when(number % 7 == 1, F.concat(size, F.lit("-"), size + 5, F.lit("mL")))
        .when(number % 7 == 2, F.concat(F.lit(">"), size, F.lit("000mL")))
        .when(number % 7 == 3, F.concat(F.lit("1-"), big))
        .when(number % 7 == 4, F.concat(F.lit(">"), big))
        .when(number % 7 == 5, F.concat(size, F.lit("+")))
        .otherwise("per request")
    )
    labelled = _part(spark, sf).select("p_partkey", label.alias("label"))
    low, high = label_bounds(F.col("label"))
    return labelled.select("p_partkey", "label", low.alias("low"), high.alias("high"))


@query
def clause_prices(spark, sf):
    return extract.parse_clauses(testdata.clause_sections(tables.spread(_part(spark, sf))))


@query
def normalize_prices(spark, sf):
    rows = normalize.normalize_prices(
        testdata.raw_price_rows(_part(spark, sf)), show_currency_used=True
    )
    bounds = ("min_quantity_tier", "max_quantity_tier")
    return rows.withColumns({c: F.col(c).cast("bigint") for c in bounds})


@query
def normalize_prices_b(spark, sf):
    rows = normalize.normalize_prices(testdata.raw_price_rows(_part(spark, sf)), method="B")
    return rows.select("sample_size", "region", "currency", "price", "extraction_method")


@query
def fee_prices(spark, sf):
    raw = testdata.raw_fee_rows(_part(spark, sf))
    return normalize.normalize_fees(raw).unionByName(normalize.normalize_fees(raw, method="B"))


# --- validation and comparison -------------------------------------------------------------------

def _validated_prices(spark, sf):
    rows = testdata.extracted_prices(spark, sf)
    return validate.validate_prices(rows, testdata.truth_prices(rows))


def _validated_fees(spark, sf):
    rows = _fees(spark, sf)
    return validate.validate_fees(rows, testdata.truth_fees(rows))


@query
def validate_prices(spark, sf):
    return _validated_prices(spark, sf).select(
        "customer_id", "filename", "extraction_method", "temperature", "sample_size",
        "quantity_tier", "region", "currency", "extracted_price", "expected_price",
        "extracted_price_num", "expected_price_num", "price_delta", "price_delta_pct",
        "match_status",
    )


@query
def validate_fees(spark, sf):
    return _validated_fees(spark, sf).select(
        "customer_id", "extraction_method", "fee_category", "fee_name", "currency",
        "extracted_price", "expected_price", "price_delta", "match_status",
    )


@query
def validation_mismatches(spark, sf):
    return metrics.by_status(_validated_prices(spark, sf), "MISMATCH").select(
        "customer_id", "extraction_method", "temperature", "sample_size", "quantity_tier",
        "extracted_price", "expected_price", "match_status",
    )


@query
def validation_summary(spark, sf):
    return validate.validation_summary(
        STORAGE_PRICING=_validated_prices(spark, sf), MANAGEMENT_FEES=_validated_fees(spark, sf)
    )


@query
def method_counts(spark, sf):
    prices = runs.method_counts(testdata.extracted_prices(spark, sf))
    fees = runs.method_counts(_fees(spark, sf))
    return prices.withColumn("table_type", F.lit("prices")).unionByName(
        fees.withColumn("table_type", F.lit("fees"))
    )


@query
def compare_methods_region(spark, sf):
    return compare.compare_methods(
        testdata.extracted_prices(spark, sf), compare.PRICE_KEYS, "A", "B"
    )


@query
def compare_methods_noregion(spark, sf):
    return compare.compare_methods(
        testdata.extracted_prices(spark, sf), compare.PRICE_KEYS_NO_REGION, "A", "B",
        missing=False,
    )


@query
def compare_methods_fees(spark, sf):
    return compare.compare_methods(_fees(spark, sf), compare.FEE_KEYS, "A", "B")


@query
def compare_methods_full(spark, sf):
    """B is the left side here, so the rows only A has show up as A_MISSING."""
    return compare.compare_methods(
        testdata.extracted_prices(spark, sf), compare.PRICE_KEYS, "B", "A", how="full"
    )


@query
def compare_tally(spark, sf):
    return compare.compare_tally(compare_methods_region(spark, sf))


# --- shuffled ways, contract texts to billing, failing pages --------------------------------------

@query
def billing_anomalies_shuffled(spark, sf):
    return _anomalies(spark, sf, limit=0)


@query
def billing_single_match_shuffled(spark, sf):
    return _anomalies(spark, sf, single=True, limit=0)


@query
def compare_methods_shuffled(spark, sf):
    return compare.compare_methods(
        testdata.extracted_prices(spark, sf), compare.PRICE_KEYS, "A", "B", limit=0
    )


def _document_rates(spark, sf):
    line = r"(?m)^([^|\n]+)\|([^|\n]+)\|([^|\n]+)\|([^|\n]+)$"
    groups = {"temperature": 1, "container_size": 2, "tier_label": 3, "unit_price": 4}
    missing = F.transform(
        F.regexp_extract_all("text", F.lit(line), 1), lambda _: F.lit(None).cast("string"))
    rules = {f: (line, groups[f]) if f in groups else missing for f in extract.RATE_LINE_FIELDS}
    day = r"(?m)^{}: (\S+)$"
    dates = {"effective_date": (day.format("Effective"), 1), "expiry_date": (day.format("Expires"), 1)}
    return contracts.extract_rates(testdata.rate_documents(spark, sf), rules, dates)


@query
def document_rates_summary(spark, sf):
    """Contract texts to a rate card, and billing classified against it."""
    rates, _, _ = _document_rates(spark, sf)
    return anomaly.anomaly_summary(anomaly.billing_anomalies(testdata.billing(spark, sf), rates))


@query
def document_rate_rejects(spark, sf):
    _, rejects, _ = _document_rates(spark, sf)
    return rejects.groupBy("contract_id", "reason").agg(F.count("*").alias("row_count"))


@query
def document_rate_status(spark, sf):
    return _document_rates(spark, sf)[2]


def _link_client():
    def client(texts):
        if any(len(t) % 2 for t in texts):
            raise ValueError("odd page")
        return [{"fee_name": [str(len(t))]} for t in texts]
    return client


@query
def extractor_errors(spark, sf):
    """A client that refuses some pages; only these are lost."""
    found = extract.extract_arrays(
        testdata.table(spark, sf, "pages").select("page_id", "html"), extractor=_link_client,
        fields=("fee_name",), text="html")
    return found.select("page_id", F.get("extraction.fee_name", F.lit(0)).alias("size"), "error")


@query
def extract_json_null_counts(spark, sf):
    """An explicit JSON null is enough for the required field."""
    return extract.flatten_rows(
        _document_json(spark, sf), "result_json", "rows", ("fee_category", "fee_name", "unit"),
        keep=("doc_id",), required="fee_name", null_counts=True,
    )


# --- search --------------------------------------------------------------------------------------

def _sections(spark, sf):
    rows = testdata.table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return tables.spread(rows, "doc_id")


def _questions(spark, sf):
    return testdata.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query
def search_bm25(spark, sf):
    return search.search(search.build_index(_sections(spark, sf)), _questions(spark, sf), 10)


@query
def search_filtered(spark, sf):
    index = search.build_index(_sections(spark, sf), attributes=("lang", "source"))
    return search.search(index, _questions(spark, sf), 5, {"lang": "en", "source": "src1"})


@query
def semantic_vectors(spark, sf):
    """The vector of every document by the decomposition of all documents' words."""
    rows = tables.stage(semantic.counted(_sections(spark, sf)), "features")
    return semantic.counted_vectors(rows, semantic.fit_counted(rows))


@query
def search_hybrid(spark, sf):
    """The questions by words and by meaning, fused."""
    sections = _sections(spark, sf)
    rows = tables.stage(semantic.counted(sections), "features")
    model = semantic.fit_counted(rows)
    vectors = tables.stage(semantic.counted_vectors(rows, model), "section-vectors")
    return semantic.hybrid_search(search.build_index(sections), vectors, _questions(spark, sf), model, 10)


@query
def vector_topk(spark, sf):
    """Vectors nearest to the mean vector of each label."""
    vectors = testdata.table(spark, sf, "embeddings")
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    mean = F.array(*[F.avg(F.get("embedding", F.lit(i))) for i in range(width)])
    centers = vectors.groupBy(F.col("label").alias("query_id")).agg(mean.alias("embedding"))
    return search.vector_topk(vectors, centers, 10)


def _twentieth(spark, sf):
    """Every vector whose id is divisible by 20, as a query."""
    vectors = testdata.table(spark, sf, "embeddings").filter("vec_id % 20 = 0")
    return vectors.select(F.col("vec_id").alias("query_id"), "embedding")


@query
def vector_ivf_topk(spark, sf):
    """The ten nearest of every twentieth vector by the inverted file over all vectors."""
    index = ivf.build(testdata.table(spark, sf, "embeddings"))
    return ivf.topk(spark, index, _twentieth(spark, sf), 10)


@query
def vector_ivf_recall(spark, sf):
    """Whether the inverted file finds nine tenths of the exact results."""
    exact = search.vector_topk(testdata.table(spark, sf, "embeddings"), _twentieth(spark, sf), 10)
    return ivf.recall(vector_ivf_topk(spark, sf), exact).select("exact_results", "reached")


@query
def index_refresh_delta(spark, sf):
    """Earlier state: without one source, and with older texts in one language."""
    now = _sections(spark, sf).select("doc_id", "text", "lang", "source")
    before = now.filter(F.col("source") != "src3").withColumn(
        "text", F.when(F.col("lang") == "fr", F.concat(F.lit("old "), F.col("text")))
        .otherwise(F.col("text"))
    )
    now = now.filter(F.col("source") != "src4")
    changes, fresh = search.index_delta(now, search.build_index(before))
    sizes = fresh.docs.select("doc_id", "doc_len")
    return changes.join(sizes, "doc_id", "left")


@query
def search_refreshed(spark, sf):
    """The index of an earlier state, brought up to date, then searched."""
    now = _sections(spark, sf).select("doc_id", "text", "lang", "source")
    before = now.filter(F.col("source") != "src3").withColumn(
        "text", F.when(F.col("lang") == "fr", F.concat(F.lit("old "), F.col("text")))
        .otherwise(F.col("text")))
    now = now.filter("source <> 'src4'")
    index = search.build_index(before)
    changes, fresh = search.index_delta(now, index)
    return search.search(search.apply_delta(index, changes, fresh), _questions(spark, sf), 10)


# --- runs ----------------------------------------------------------------------------------------

@query
def table_row_counts(spark, sf):
    return tables.row_counts(**{n: testdata.table(spark, sf, n) for n in testdata.SCHEMAS})


@query
def named_table_scan(spark, sf):
    name = f"audit_labels_{abs(hash(sf))}"
    testdata.table(spark, sf, "labels").createOrReplaceTempView(name)
    return tables.read_named(spark, name).groupBy("quality", "toxic").agg(
        F.count("*").alias("row_count")
    )


@query
def run_report(spark, sf):
    prices = testdata.extracted_prices(spark, sf)
    fees = _fees(spark, sf)
    page_rows = _part(spark, sf).select(F.col("p_brand").alias("customer_id"))
    return runs.run_report(page_rows, prices, fees)


@query
def contract_status(spark, sf):
    log = testdata.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("contract_id"),
        F.when(F.col("o_orderstatus") == "F", "FAILED")
        .when(F.col("o_orderstatus") == "O", "EXTRACTED")
        .otherwise("PENDING").alias("status"),
        F.col("o_orderdate").alias("logged_at"),
        F.col("o_orderkey").alias("run_id"),
    )
    return runs.contract_status(log)


@query
def keyed_replace(spark, sf):
    """First run writes all rows; the second re-runs two customers' B method, one without rows."""
    path = scratch_path(spark, "keyed-replace")
    rows = testdata.extracted_prices(spark, sf)
    runs.replace_keys(rows, path, rows.select(*runs.RESULT_KEYS))
    again = rows.filter(
        (F.col("extraction_method") == "B") & F.col("customer_id").isin("BUILDING", "MACHINERY")
    )
    second = again.filter(F.col("customer_id") == "BUILDING").withColumn("price", F.lit("9.99"))
    runs.replace_keys(second, path, again.select(*runs.RESULT_KEYS))
    return runs.read_current(spark, path).select(
        "customer_id", "extraction_method", "temperature", "sample_size", "quantity_tier", "price"
    )


@query
def append_and_dedupe(spark, sf):
    """Appending the same rows twice doubles them; with keys the second append adds nothing."""
    rows = _fees(spark, sf)
    keys = ["customer_id", "fee_category", "fee_name", "extraction_method"]
    plain, keyed = scratch_path(spark, "append"), scratch_path(spark, "append-keyed")
    for _ in range(2):
        tables.append_rows(rows, plain)
        tables.append_rows(rows, keyed, dedupe=keys)
    return tables.row_counts(
        appended=spark.read.parquet(plain), deduplicated=spark.read.parquet(keyed)
    )


@query
def stored_documents(spark, sf):
    """All texts written as files, then listed and read back: bytes per language folder."""
    path = scratch_path(spark, "documents")
    texts = testdata.table(spark, sf, "documents").select("lang", "text")
    texts.write.option("maxRecordsPerFile", 5000).partitionBy("lang").text(path)
    lang = F.regexp_extract("path", "/lang=([^/]+)/", 1).alias("lang")
    listed = documents.list_documents(spark, path, "*.txt").groupBy(lang).agg(
        F.sum("size").alias("listed_bytes"))
    read = documents.read_documents(spark, path, "*.txt").groupBy(lang).agg(
        F.sum(F.length("content").cast("bigint")).alias("read_bytes"))
    return listed.join(read, "lang")


@query
def csv_export(spark, sf):
    path = scratch_path(spark, "csv")
    rows = _fees(spark, sf).filter(F.col("extraction_method") == "A").select(
        "customer_id", "fee_category", "fee_name", "price", "unit"
    )
    tables.export_csv(rows, path)
    schema = "customer_id string, fee_category string, fee_name string, price string, unit string"
    return spark.read.schema(schema).option("header", True).csv(path)


@query
def run_both_methods(spark, sf):
    """Links of all web pages through both kinds of extraction in one job."""
    rules = {"fee_category": (LINK, 1), "fee_name": (LINK, 2)}
    missing = {f: F.array().cast("array<string>") for f in extract.FEE_FIELDS if f not in rules}
    missing["price_usd"] = F.transform(
        F.regexp_extract_all("html", F.lit(LINK), 2), lambda x: F.length(x).cast("string")
    )
    rules = {f: {**rules, **missing}[f] for f in extract.FEE_FIELDS}
    docs = testdata.table(spark, sf, "pages").select(
        F.col("url").alias("filename"), F.lit("web").alias("customer_id"), "html"
    )
    keep = ("filename", "customer_id")

    def arrays(df):
        found = extract.extract_arrays(df, rules, text="html")
        rows = extract.zip_flatten(
            found, "extraction", "fee_category", extract.FEE_FIELDS, keep
        )
        return normalize.normalize_fees(rows.drop("row_index"))

    def objects(df):
        found = extract.extract_json(df, rules, root="fee_rows", text="html")
        rows = extract.flatten_rows(
            found, "result_json", "fee_rows", extract.FEE_FIELDS, keep, "fee_name"
        )
        return normalize.normalize_fees(rows, method="B")

    return runs.run_methods(docs, {"A": arrays, "B": objects}).select(
        "filename", "fee_category", "fee_name", "price", "extraction_method"
    )


def _contract_method():
    """Rules for the lines of the contract texts."""
    line = r"(?m)^([^|\n]+)\|([^|\n]+)\|([^|\n]+)\|([^|\n]+)\|([^|\n]*)\|([^|\n]*)$"
    fee = r"(?m)^([^|\n]+)\|([^|\n]+)\|([^|\n]+)$"

    def rules(pattern, fields, groups):
        def column(field):
            if field not in groups:
                return F.array().cast("array<string>")
            found = F.regexp_extract_all("page_text", F.lit(pattern), groups[field])
            return F.transform(found, lambda x: F.when(x != "", x))
        return {f: column(f) for f in fields}

    return contracts.Method("A", price_rules=rules(line, extract.PRICE_FIELDS, {
        "temperature": 1, "sample_size_label": 2, "qty_tier_label": 3, "price_usd": 4,
        "region": 5, "price_eur": 6,
    }), fee_rules=rules(fee, extract.FEE_FIELDS, {
        "fee_category": 1, "fee_name": 2, "price_usd": 3,
    }))


@query
def extract_contracts(spark, sf):
    """Contract texts through the whole flow: pages, cache, both result tables, run log."""
    method = _contract_method()
    store = contracts.Store(scratch_path(spark, "contracts"))
    docs = testdata.contract_documents(_part(spark, sf))
    contracts.extract_contracts(spark, docs, store, method, run_id=1)
    return _stored_lines(spark, store)


@query
def contract_methods_run(spark, sf):
    """All contract texts through both methods, one of them with two models, over one page cache."""
    a = _contract_method()
    methods = [a] + [
        contracts.Method("B", model, a.price_rules, a.fee_rules) for model in pages.MODELS[:2]
    ]
    store = contracts.Store(scratch_path(spark, "contract-methods"))
    contracts.extract_all(spark, testdata.contract_documents(_part(spark, sf)), store, methods, 1)
    return _stored_lines(spark, store)


@query
def two_contract_runs(spark, sf):
    """Customer numbers with leading zeros. The first run covers all documents; in the second, one
    customer names half of another's files and a third customer's pages fail."""
    part = _part(spark, sf)
    number = F.lpad((F.col("p_partkey") % 10).cast("string"), 5, "0").alias("number")
    docs = testdata.contract_documents(part).drop("customer_id").join(
        part.select(F.concat(F.lit("contract "), F.col("p_partkey"), F.lit(".pdf")).alias("filename"),
                    number, (F.col("p_partkey") % 4 == 3).alias("shared")), "filename")
    # The parts may be one row group, then one task would do all that follows the scan.
    docs = tables.stage(docs.repartition(spark.sparkContext.defaultParallelism), "numbered")
    store = contracts.Store(scratch_path(spark, "contract-runs"))
    first = docs.select("filename", F.col("number").alias("customer_id"), "text")
    contracts.extract_contracts(spark, first, store, _contract_method(), run_id=1)
    again = docs.filter("number = '00003' and shared").select(
        "filename", F.lit("00042").alias("customer_id"), "text")
    contracts.extract_contracts(spark, again, store, _contract_method(), run_id=2)
    failing = contracts.Method(
        "A", price_extractor=_no_service, fee_extractor=_no_service)
    lost = first.filter("customer_id = '00007'")
    contracts.extract_contracts(spark, lost, store, failing, run_id=3)
    return _stored_lines(spark, store)


def _no_service():
    """An extractor whose service can't be reached."""
    raise ConnectionError("service not reachable")


def _stored_lines(spark, store):
    prices = runs.read_current(spark, store.prices).select(
        F.lit("price").alias("kind"), "filename", "customer_id", F.col("temperature").alias("name"),
        "region", "currency", "price", "extraction_method")
    fees = runs.read_current(spark, store.fees).select(
        F.lit("fee").alias("kind"), "filename", "customer_id", F.col("fee_name").alias("name"),
        F.lit(None).cast("string").alias("region"), "currency", "price", "extraction_method")
    return prices.unionByName(fees)


@query
def layout_cells(spark, sf):
    """The slots of the price tables in documents, with their header paths."""
    docs = tables.spread(testdata.price_table_documents(_part(spark, sf)))
    return layout.table_cells(docs).select(
        "filename", "table_index", "row_index", "column_index", "header_path", "value", "spanned"
    )


@query
def layout_prices(spark, sf):
    """Rows of the price tables by header path, prices as numbers."""
    docs = tables.spread(testdata.price_table_documents(_part(spark, sf)))
    columns = {"brand": "Brand", "kind": "Kind", "small": "Unit price / 1-10", "large": "Unit price / 26-40"}
    rows = layout.table_rows(layout.table_cells(docs), columns)
    return rows.select(
        "filename", "customer_id", "brand", "kind",
        *[F.col(c).try_cast("decimal(18,2)").cast("double").alias(c) for c in ("small", "large")],
    )


# --- streaming -----------------------------------------------------------------------------------

def _changes(spark, sf):
    """Four batches of section changes: an earlier state, a source added, texts corrected, a source
    removed."""
    now = _sections(spark, sf).select("doc_id", "text", "source", "lang")
    old = F.when(F.col("lang") == "fr", F.concat(F.lit("old "), F.col("text"))).otherwise(F.col("text"))
    batches = [
        now.filter("source <> 'src3'").withColumn("text", old), now.filter("source = 'src3'"),
        now.filter("lang = 'fr'"), now.filter("source = 'src4'"),
    ]
    return [
        rows.select("doc_id", "text", F.lit(i == 3).alias("removed")) for i, rows in enumerate(batches)
    ]


@query
def search_segmented(spark, sf):
    """The index after four batches of changes, searched."""
    index = segments.SegmentedIndex(spark, scratch_path(spark, "segmented"))
    for number, changes in enumerate(_changes(spark, sf)):
        index.apply(changes, number)
    return search.search(index.index(), _questions(spark, sf), 10)


@query
def stream_pages(spark, sf):
    arriving = testdata.stream(spark, sf, "documents").select(
        F.concat_ws("/", "source", "doc_id").alias("filename"),
        F.col("lang").alias("customer_id"), "text",
    )
    path = scratch_path(spark, "pages")
    jobs.stream_pages(
        arriving, f"{path}/cache", f"{path}/checkpoint", parsed_at=_parsed_at()
    ).awaitTermination()
    return spark.read.parquet(f"{path}/cache").select(
        "filename", "customer_id", "page_index", "page_text", "total_pages"
    )


@query
def stream_changed_pages(spark, sf):
    """All documents arrive with an older text where the language is French, then all as they are."""
    path = scratch_path(spark, "page-versions")
    docs = testdata.table(spark, sf, "documents").select(
        F.concat_ws("/", "source", "doc_id").alias("filename"), F.col("lang").alias("customer_id"), "text",
        "lang",
    )
    old = F.when(F.col("lang") == "fr", F.concat(F.lit("old "), "text")).otherwise(F.col("text"))
    for day, arriving in ((1, docs.withColumn("text", old)), (2, docs)):
        stamped = arriving.withColumn("modified_at", F.timestamp_seconds(F.lit(86400 * day)))
        stamped.drop("lang").write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(stamped.drop("lang").schema).parquet(f"{path}/in")
        versions.stream_page_versions(
            stream, f"{path}/cache", f"{path}/checkpoint", parsed_at=_parsed_at()
        ).awaitTermination()
    return versions.current_pages(spark, f"{path}/cache").select(
        "filename", "customer_id", "page_index", "page_text", "total_pages"
    )


@query
def stream_anomalies(spark, sf):
    lines = testdata.stream(spark, sf, "lineitem")
    path = scratch_path(spark, "anomalies")
    jobs.stream_anomalies(
        testdata.billing(spark, sf, lines), lambda s: testdata.rate_card(s, sf),
        f"{path}/flags", f"{path}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{path}/flags").drop("batch_id")


def _late_amendments(spark, sf):
    """Billing, the card without its amendments (SOW contracts), and these. Billing is read three times
    and derived by joins of whole tables, so it is written once."""
    billing, card = tables.stage(testdata.billing(spark, sf), "billing"), testdata.rate_card(spark, sf)
    late = F.col("contract_id").startswith("SOW")
    return billing, card.filter(~late), card.filter(late)


@query
def late_amendments(spark, sf):
    """Anomalies under the early card plus what the amendments change: the anomalies of the whole card."""
    billing, card, late = _late_amendments(spark, sf)
    early = anomaly.billing_anomalies(billing, card).withColumn("change", F.lit(1).cast("long"))
    rows = early.unionByName(anomaly.amendment_feed(billing, card, late)).repartition("txn_id")
    names = [c for c in early.columns if c != "change"]
    left = rows.groupBy(*names).agg(F.sum("change").alias("change"))
    return left.withColumn("copy", F.explode(F.expr("array_repeat(0, cast(change as int))"))).select(names)


@query
def summary_kept_current(spark, sf):
    """The summary after a batch of anomalies and a batch of what late amendments change in them."""
    billing, card, late = _late_amendments(spark, sf)
    early = anomaly.billing_anomalies(billing, card).withColumn("change", F.lit(1).cast("long"))
    path = scratch_path(spark, "summary")
    for rows in (early, anomaly.amendment_feed(billing, card, late)):
        rows.write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(early.schema).parquet(f"{path}/in")
        summaries.stream_summary(arriving, f"{path}/state", f"{path}/checkpoint").awaitTermination()
    return summaries.current_summary(spark, f"{path}/state")


@query
def stream_alerts(spark, sf):
    lines = testdata.stream(spark, sf, "lineitem")
    path = scratch_path(spark, "alerts")
    jobs.stream_anomalies(
        testdata.billing(spark, sf, lines), lambda s: testdata.rate_card(s, sf),
        f"{path}/flags", f"{path}/checkpoint",
        alert_path=f"{path}/alerts", alert_threshold=5000.0,
    ).awaitTermination()
    return spark.read.parquet(f"{path}/alerts").select(
        "txn_id", "contract_id", "customer_name", "revenue_impact", "anomaly_type"
    )


def _in_waves(spark, rows, kind, delay, path):
    """``rows`` arrive in three waves by their column ``wave``; each is a batch of the windows' stream."""
    for number in range(3):
        wave = rows.filter(F.col("wave") == number).drop("wave")
        wave.write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(wave.schema).parquet(f"{path}/in")
        event_time.stream_windows(
            arriving, kind, f"{path}/out", f"{path}/checkpoint", delay
        ).awaitTermination()


def _event_waves(spark, sf):
    """Events of the first half of a month come first, then those of the second; one in twenty comes a
    wave later."""
    late = F.when(F.col("event_id") % 20 == 7, 1).otherwise(0)
    return testdata.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", windows.micros(F.col("ts")).alias("at"), "value",
        (F.when(F.dayofmonth("ts") <= 15, 0).otherwise(1) + late).alias("wave"),
    )


STORM_GAP, EVENT_DELAY = 12 * 3600 * 1_000_000, 2 * 86400 * 1_000_000


@query
def event_storms(spark, sf):
    """Events of a user and type that follow each other within twelve hours, as one alert each."""
    kind = windows.Sessions(("user_id", "event_type"), STORM_GAP)
    path = scratch_path(spark, "storms")
    _in_waves(spark, _event_waves(spark, sf), kind, EVENT_DELAY, path)
    return event_time.current_windows(spark, f"{path}/out", kind).select(
        "user_id", "event_type", "first", "last", F.col("rows").alias("n_events"),
        F.col("total").cast("double").alias("total"), "closed",
    )


@query
def late_events(spark, sf):
    """The events that came behind the watermark, with the wave they came in."""
    path = scratch_path(spark, "late-events")
    _in_waves(spark, _event_waves(spark, sf), windows.Sessions(("user_id",), STORM_GAP), EVENT_DELAY, path)
    return event_time.late_rows(spark, f"{path}/out").select(
        "event_id", "user_id", F.col("at").alias("at_micros"), F.col("batch_id").cast("long").alias("wave")
    )


@query
def sliding_impact(spark, sf):
    """Impact per customer in windows of four weeks that begin every week, over transactions that
    arrive in waves."""
    late = F.when(F.col("quantity") % 20 == 7, 1).otherwise(0)
    rows = _anomalies(spark, sf).select(
        "customer_name", F.unix_date("txn_date").cast("long").alias("at"),
        F.col("revenue_impact").alias("value"),
        (F.when(F.col("txn_date") < F.lit("1998-01-01").cast("date"), 0).otherwise(1) + late).alias("wave"),
    )
    kind = windows.Sliding(("customer_name",), 28, 7)
    path = scratch_path(spark, "sliding")
    _in_waves(spark, rows, kind, 30, path)
    return event_time.current_windows(spark, f"{path}/out", kind).select(
        "customer_name", F.date_add(F.lit("1970-01-01").cast("date"), F.col("begin").cast("int")).alias("begin"),
        F.col("rows").alias("n_rows"), F.col("total").cast("double").alias("total_impact"), "closed",
    )


LIFECYCLE_LIMIT, LIFECYCLE_DELAY = 30, 60


def _lifecycle_rows(spark, sf):
    """Orders as status rows of their customer's contract; one in twenty arrives a wave later."""
    late = F.when(F.col("o_orderkey") % 20 == 7, 1).otherwise(0)
    status = F.when(F.col("o_orderstatus") == "P", "PENDING").when(F.col("o_orderstatus") == "F", "EXTRACTED")
    day = F.col("o_orderdate").cast("date")
    return testdata.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("contract_id"), status.otherwise("FAILED").alias("status"),
        F.unix_date(day).cast("long").alias("at"), F.col("o_orderkey").alias("seq"),
        (F.when(day < F.lit("1998-01-01").cast("date"), 0).otherwise(1) + late).alias("wave"),
    )


def _log_columns(log):
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.col("at").cast("int"))
    return log.select("contract_id", day.alias("day"), "status", "seq", "kind")


@query
def contract_lifecycle(spark, sf):
    """Changes, illegal ones and missed deadlines of all contracts."""
    return _log_columns(lifecycle.lifecycle_log(_lifecycle_rows(spark, sf), LIFECYCLE_LIMIT))


@query
def stream_lifecycle(spark, sf):
    """The same for rows that arrive in waves, up to the watermark."""
    path, rows = scratch_path(spark, "lifecycle"), _lifecycle_rows(spark, sf)
    for number in range(3):
        wave = rows.filter(F.col("wave") == number).drop("wave")
        wave.write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(wave.schema).parquet(f"{path}/in")
        lifecycle_stream.stream_lifecycle(
            arriving, f"{path}/out", f"{path}/checkpoint", LIFECYCLE_LIMIT, LIFECYCLE_DELAY
        ).awaitTermination()
    return _log_columns(lifecycle_stream.current_log(spark, f"{path}/out"))


@query
def overdue_contracts(spark, sf):
    """Where each contract stands, and how often it missed a deadline."""
    log = lifecycle.lifecycle_log(_lifecycle_rows(spark, sf), LIFECYCLE_LIMIT)
    return lifecycle.latest_status(log).select("contract_id", "status", "times_overdue")


@query
def stream_search(spark, sf):
    arriving = testdata.stream(spark, sf, "documents").select("doc_id", "text")
    path = scratch_path(spark, "index")
    jobs.stream_index(
        arriving, f"{path}/index", f"{path}/checkpoint"
    ).awaitTermination()
    return search.search(
        jobs.load_streamed_index(spark, f"{path}/index"), _questions(spark, sf), 10
    )
