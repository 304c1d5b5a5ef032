from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from pricing_audit.operators import metrics, runs
from pricing_audit.session import scratch_path, shared_dir
from pricing_audit.sources import documents, schemas, tables

SCHEMA = "customer_id string, extraction_method string, filename string, price string"


def state(spark, path):
    return sorted(tuple(r) for r in runs.read_current(spark, path).select(
        "customer_id", "extraction_method", "filename", "price").collect())


def test_replace_is_repeatable_and_clears_empty_keys(spark):
    path = scratch_path(spark, "test-replace")
    first = spark.createDataFrame(
        [("a", "A", "f", "1"), ("a", "B", "f", "2"), ("b", "A", "g", "3")], SCHEMA)
    keys = first.select(*runs.RESULT_KEYS)
    for _ in range(2):
        runs.replace_keys(first, path, keys)
        assert state(spark, path) == sorted(tuple(r) for r in first.collect())
    again = spark.createDataFrame([("a", "A", "f", "9"), ("a", "A", "h", "8")], SCHEMA)
    both = spark.createDataFrame([("a", "A"), ("b", "A")], "customer_id string, extraction_method string")
    for _ in range(2):
        runs.replace_keys(again, path, both)
        assert state(spark, path) == [
            ("a", "A", "f", "9"), ("a", "A", "h", "8"), ("a", "B", "f", "2")]
    by_file = scratch_path(spark, "test-replace-file")
    wide = ("customer_id", "filename", "extraction_method")
    runs.replace_keys(first, by_file, first.select(*wide), wide)
    assert state(spark, by_file) == sorted(tuple(r) for r in first.collect())


def test_append(spark):
    path = scratch_path(spark, "test-append")
    rows = spark.createDataFrame([("a", "A", "f", "1"), ("a", "B", "f", "2")], SCHEMA)
    tables.append_rows(rows, path, ["customer_id"])
    tables.append_rows(rows, path, ["customer_id"])
    assert spark.read.parquet(path).count() == 4
    tables.append_rows(rows, path, ["customer_id"], dedupe=["customer_id", "extraction_method"])
    assert spark.read.parquet(path).count() == 4


def test_status_and_report(spark):
    def at(day):
        return datetime.datetime(2025, 1, day)

    log = spark.createDataFrame(
        [("c1", "PENDING", at(1), 1), ("c1", "EXTRACTED", at(2), 2), ("c1", "FAILED", at(2), 3),
         ("c2", "PENDING", at(1), 1)],
        "contract_id string, status string, logged_at timestamp_ntz, run_id long")
    got = {r.contract_id: (r.extraction_status, r.extracted_at)
           for r in runs.contract_status(log).collect()}
    assert got == {"c1": ("FAILED", at(2)), "c2": ("PENDING", None)}
    rows = spark.createDataFrame(
        [("a", "A", "f", "1"), ("a", "A", "f", "2"), ("b", "B", "f", "2")], SCHEMA)
    page_rows = spark.createDataFrame([("a",)] * 3, "customer_id string")
    report = runs.run_report(page_rows, rows, rows.filter("customer_id = 'a'"))
    assert sorted(tuple(r) for r in report.collect()) == [
        ("a", "A", 3, 2, 2), ("b", "B", 0, 1, 0)]


def test_files(spark, tmp_path):
    for day, name in enumerate(("a.pdf", "b c.pdf", "note.txt")):
        folder = tmp_path / f"d{day}"
        folder.mkdir()
        (folder / name).write_text(f"text of {name}")
        os.utime(folder / name, (1_700_000_000 + day, 1_700_000_000 + day))
    listing = documents.list_documents(spark, str(tmp_path), "*.pdf")
    assert [(r.filename, r.size) for r in listing.collect()] == [("b c.pdf", 15), ("a.pdf", 13)]
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("Format")[0]
    texts = documents.read_text_documents(spark, str(tmp_path), "*.pdf")
    assert sorted(r.text for r in texts.collect()) == ["text of a.pdf", "text of b c.pdf"]
    batch = documents.folder_documents(spark, str(tmp_path))
    assert sorted((r.filename, r.customer_id) for r in batch.collect()) == [
        ("a.pdf", "a"), ("b c.pdf", "b_c")]


def test_schemas_and_defaults(spark):
    rows = spark.createDataFrame([("c", "x", "9.5")], "contract_id string, customer_name string, unit_price string")
    row = schemas.conform(rows, "contract_pricing").first()
    assert (row.unit_price, row.currency, row.temperature) == (9.5, "USD", None)
    assert row.created_at is not None
    contract = schemas.conform(rows.drop("unit_price"), "contract_metadata").first()
    assert (contract.extraction_status, contract.extracted_at) == ("PENDING", None)
    with pytest.raises(ValueError):
        schemas.conform(rows, "contract_metadata")
    for name in schemas.TABLES:
        assert schemas.empty_table(spark, name).count() == 0


def test_export_and_named_tables(spark):
    rows = spark.createDataFrame([("a", "A", "f,1", "1"), ("b", "A", "g", None)], SCHEMA)
    path = scratch_path(spark, "test-csv")
    tables.export_csv(rows, path)
    back = spark.read.schema(SCHEMA).option("header", True).csv(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    rows.createOrReplaceTempView("chosen_at_run_time")
    names = tables.TableNames("", prices="chosen_at_run_time")
    assert tables.read_named(spark, names.full("prices")).count() == 2
    assert tables.TableNames("db.schema").full("fees") == "db.schema.extracted_fees"
    values = metrics.distinct_values(rows, "customer_id", "extraction_method")
    assert [tuple(r) for r in values.collect()] == [
        ("customer_id", "a"), ("customer_id", "b"), ("extraction_method", "A")]
    assert metrics.preview(rows, [F.desc("customer_id")], 1).first().customer_id == "b"


class FakeSession:
    """The two things the folder choice looks at."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = settings


def test_shared_dir_follows_the_session(spark):
    named = FakeSession("spark://cluster:7077", {"spark.checkpoint.dir": "/shared/place/"})
    assert shared_dir(named) == "/shared/place"
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession("spark://cluster:7077", {}))
    assert os.path.isdir(shared_dir(FakeSession("local[2]", {})))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_methods_in_one_job(spark):
    rows = spark.createDataFrame([("a",)], "customer_id string")
    both = runs.run_methods(rows, {
        m: lambda df, m=m: df.withColumn("extraction_method", F.lit(m)) for m in ("A", "B")})
    assert sorted(r.extraction_method for r in both.collect()) == ["A", "B"]
    with pytest.raises(TypeError):
        runs.run_methods(rows, {})
