from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pricing_audit.operators import extract, pages, runs
from pricing_audit.plans.contracts import Method, Store, extract_contracts, parse_documents
from pricing_audit.session import scratch_path

DOCS = [
    ("a.pdf", "acme", "Storage table\nRT|5-10mL|1-10|2.50|Griesheim|2.25\n"
                      "LN2|5-10mL|1-10|4.00||\nx\ny\nRegistration fees\nLab|Intake|9.00\n"),
    ("b.pdf", "bond", "Nothing of interest"),
]
SCHEMA = "filename string, customer_id string, text string"
PRICE = r"(?m)^([^|\n]+)\|([^|\n]+)\|([^|\n]+)\|([^|\n]*)\|([^|\n]*)\|([^|\n]*)$"
FEE = r"(?m)^([^|\n]+)\|([^|\n]+)\|([^|\n]+)$"


def texts(pattern, group):
    found = F.regexp_extract_all("page_text", F.lit(pattern), group)
    return F.transform(found, lambda x: F.when(x != "", x))


def price_rules():
    groups = {"temperature": 1, "sample_size_label": 2, "qty_tier_label": 3, "price_usd": 4,
              "region": 5, "price_eur": 6}
    empty = F.array().cast("array<string>")
    return {f: texts(PRICE, groups[f]) if f in groups else empty for f in extract.PRICE_FIELDS}


def fee_rules():
    groups = {"fee_category": 1, "fee_name": 2, "price_usd": 3}
    empty = F.array().cast("array<string>")
    return {f: texts(FEE, groups[f]) if f in groups else empty for f in extract.FEE_FIELDS}


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def prices(spark, store):
    return sorted(
        (r.customer_id, r.temperature, r.currency, r.price)
        for r in runs.read_current(spark, store.prices).collect())


WANT = [("acme", "LN2", "USD", "4.00"), ("acme", "RT", "EUR", "2.25")]


@pytest.mark.parametrize("method", [
    Method("A", price_rules=None), Method("B", "mistral-large2")], ids=["arrays", "json"])
def test_documents_to_tables(spark, docs, method):
    store = Store(scratch_path(spark, "test-contracts"))
    ready = Method(method.kind, method.model, price_rules(), fee_rules())
    for run in (1, 2):
        report = extract_contracts(spark, docs, store, ready, run)
        assert [tuple(r)[0::2] for r in report.collect()] == [("acme", 2, 1)]
        assert prices(spark, store) == WANT
    assert spark.read.parquet(store.pages).count() == 3
    status = runs.contract_status(spark.read.parquet(store.log)).collect()
    assert sorted((r.contract_id, r.extraction_status, r.log_entries) for r in status) == [
        ("a.pdf", "EXTRACTED", 2), ("b.pdf", "EXTRACTED", 2)]


def test_failed_pages_are_logged_and_rows_kept(spark, docs):
    store = Store(scratch_path(spark, "test-contracts"))
    good = Method("A", price_rules=price_rules(), fee_rules=fee_rules())
    extract_contracts(spark, docs, store, good, 1)

    def broken():
        return lambda batch: [RuntimeError("no answer") for _ in batch]

    bad = Method("A", fee_rules=fee_rules(), price_extractor=broken)
    extract_contracts(spark, docs, store, bad, 2)
    assert prices(spark, store) == WANT
    assert runs.read_current(spark, store.fees).count() == 1
    last = spark.read.parquet(store.log).filter("run_id = 2").collect()
    assert {r.contract_id: (r.status, r.error) for r in last} == {
        "a.pdf": ("FAILED", "RuntimeError: no answer"), "b.pdf": ("EXTRACTED", None)}


def test_numbers_as_customers_and_a_shared_file(spark):
    """Ids keep their zeros; a second customer's run over a shared file leaves the first's rows."""
    store = Store(scratch_path(spark, "test-contracts"))
    method = Method("A", price_rules=price_rules(), fee_rules=fee_rules())
    text = "Storage table\nRT|1mL|1-10|7.00|Singapore|"
    for run, rows in enumerate((
        [("a.pdf", "00123", text), ("b.pdf", "00123", text.replace("7.00", "8.00"))],
        [("a.pdf", "2024-01-01", text)],
        [("a.pdf", "00123", text), ("b.pdf", "00123", text.replace("7.00", "8.00"))],
    )):
        extract_contracts(spark, spark.createDataFrame(rows, SCHEMA), store, method, run)
        expected = [("00123", "RT", "SGD", "7.00"), ("00123", "RT", "SGD", "8.00")]
        expected += [("2024-01-01", "RT", "SGD", "7.00")] if run else []
        assert prices(spark, store) == sorted(expected)


def test_rows_of_other_keys_are_refused(spark):
    rows = spark.createDataFrame([("a", "A", "f", "1")], "customer_id string, extraction_method string, filename string, price string")
    with pytest.raises(ValueError, match="not affected"):
        runs.replace_keys(rows, scratch_path(spark, "stray"), rows.withColumn("customer_id", rows.price))


def test_replacing_by_file_keeps_other_documents(spark, docs):
    method = Method("A", price_rules=price_rules(), fee_rules=fee_rules())
    more = spark.createDataFrame(
        [("c.pdf", "acme", "Storage table\nRT|1mL|1-10|7.00|Singapore|")], SCHEMA)
    kept, wiped = (Store(scratch_path(spark, "test-contracts")) for _ in range(2))
    for store, by_file in ((kept, True), (wiped, False)):
        for run, batch in enumerate((docs, more)):
            extract_contracts(spark, batch, store, method, run, by_file=by_file)
    assert prices(spark, kept) == sorted([*WANT, ("acme", "RT", "SGD", "7.00")])
    assert prices(spark, wiped) == [("acme", "RT", "SGD", "7.00")]


def test_models_are_checked_first(spark, docs):
    for method in (Method("B", "unheard-of"), Method("C")):
        with pytest.raises(ValueError):
            extract_contracts(spark, docs, Store("/nowhere"), method, 1)


def test_cache_is_kept(spark, docs):
    store = Store(scratch_path(spark, "test-contracts"))
    parse_documents(spark, docs, store)
    changed = docs.withColumn("text", F.lit("other"))
    assert parse_documents(spark, changed.filter("filename = 'a.pdf'"), store).count() == 2


def test_binary_parser(spark):
    files = spark.createDataFrame(
        [("a.pdf", "x", bytearray(b"one\fTwo")), ("b.pdf", "x", bytearray(b"\xff"))],
        "filename string, customer_id string, content binary")
    rows = pages.parse_files(files, lambda content: content.decode("utf-8").split("\f")).collect()
    got = sorted((r.filename, r.page_index, r.page_text, r.total_pages) for r in rows)
    assert got == [("a.pdf", 0, "one", 2), ("a.pdf", 1, "Two", 2), ("b.pdf", 0, None, 1)]
    assert [r.filename for r in rows if r.error] == ["b.pdf"]


def test_explicit_null_rule(spark):
    df = spark.createDataFrame(
        [('{"rows":[{"fee_name":null,"unit":"u"},{"unit":"v"},{"fee_name":"n"}]}',), ("{",)],
        "j string")
    strict = extract.flatten_rows(df, "j", "rows", ("fee_name", "unit"), required="fee_name")
    loose = extract.flatten_rows(
        df, "j", "rows", ("fee_name", "unit"), required="fee_name", null_counts=True)
    assert [r.fee_name for r in strict.collect()] == ["n"]
    assert [(r.fee_name, r.unit) for r in loose.collect()] == [(None, "u"), ("n", None)]
