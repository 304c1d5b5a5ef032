from __future__ import annotations

import corpus_pipeline
import pytest
from brute import near_groups
from conftest_sql import compare_with_sql
from pricing_audit.llm import queries
from pricing_audit.sources.tables import stage

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    got, want = compare_with_sql(spark, SF, name, queries.QUERIES[name], queries.ORACLE[name])
    assert got == want and got[1]


def test_every_operator_has_a_query():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, SF), "stage")
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "packing":
            assert docs.columns == columns
        if name == "exact dedup":
            texts = [" ".join(r.text.split()) for r in docs.collect()]
            assert len(texts) == len(set(texts))
        if name == "near dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            groups = near_groups(rows, 5, 80)
            assert sorted(kept[name]) == sorted({g for _, g in groups.values()})
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in truth.items() if q == 1]
    assert sum(i in set(kept["quality"]) for i in good) / len(good) > 0.97
    assert set(kept["packing"]) == set(kept["mixing"]) <= set(kept["near dedup"])
