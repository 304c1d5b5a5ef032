from __future__ import annotations

import pytest
from conftest import SF_DIR
from oracle_check import compare, connect

import __spark_entry__ as spark_entry
from pricing_audit.plans import queries
from pricing_audit.plans.oracle import ORACLE
from pricing_audit.plans.queries import QUERIES
from pricing_audit.sources import testdata


#: Compared with plain numpy in the tests of their operators; SQL has no such decomposition or index.
WITHOUT_SQL = {"semantic_vectors", "search_hybrid", "vector_ivf_topk"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    got, want = compare(spark, con, SF_DIR, name)
    assert (want is None) == (name in WITHOUT_SQL)
    assert want is None or got == want
    assert got[1], "the query returns rows"


def test_registries_agree():
    assert set(QUERIES) == set(ORACLE) | WITHOUT_SQL
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(testdata.SCHEMAS))
def test_declared_schemas(spark, name):
    inferred = spark.read.parquet(f"{SF_DIR}/{name}.parquet").schema
    declared = testdata.table(spark, SF_DIR, name).schema
    assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in inferred]


def test_derived_counts(spark):
    """Row counts of the derived tables, as specified for this data."""
    assert testdata.rate_card(spark, SF_DIR).count() == 4488
    rows = testdata.billing(spark, SF_DIR)
    assert (rows.count(), rows.select("txn_id").distinct().count()) == (6000, 5999)
    extracted = testdata.extracted_prices(spark, SF_DIR)
    assert extracted.count() == 4488 + 3828
    assert testdata.truth_prices(extracted).count() == 4125


def test_refreshed_search_removes_documents(spark, monkeypatch):
    kept, delta = [], queries.search.index_delta
    monkeypatch.setattr(queries.search, "index_delta", lambda *a: kept.append(delta(*a)) or kept[-1])
    QUERIES["search_refreshed"](spark, SF_DIR)
    assert {r.change for r in kept[0][0].select("change").distinct().collect()} == {"NEW", "CHANGED", "REMOVED"}


@pytest.mark.parametrize("name", [
    "validate_prices", "validation_mismatches", "compare_methods_region", "compare_methods_noregion",
    "compare_methods_shuffled",
])
def test_rows_of_a_larger_table(spark, name):
    got, want = compare(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", name)
    assert got == want
