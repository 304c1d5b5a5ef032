from __future__ import annotations

import collections
import math
import re
import tracemalloc

import numpy as np
import pytest
from conftest import SF_DIR
from pricing_audit.operators import search, semantic
from pricing_audit.plans import queries
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, features string, embedding string"


def plain_rows(spark, sections):
    """The dense unit tf-idf rows, by doc_id."""
    listed = {r.doc_id: r.features for r in semantic.features(sections).collect()}
    n = len(listed)
    df = collections.Counter(f for words in listed.values() for f in set(words))
    out = {}
    for doc, words in listed.items():
        row = np.zeros(semantic.WIDTH)
        for f, c in collections.Counter(words).items():
            row[f] = (1 + math.log(c)) * (math.log((1 + n) / (1 + df[f])) + 1)
        norm = math.sqrt((row * row).sum())
        out[doc] = row / norm if norm else row
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    sections = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = plain_rows(spark, sections)
    return sections, rows, semantic.fit(sections, rank=12)


def test_subspace_equals_numpy(spark, fitted):
    sections, rows, model = fitted
    ids = sorted(rows)
    _, singular, right = np.linalg.svd(np.stack([rows[i] for i in ids]), full_matrices=False)
    assert np.allclose(model.singular, singular[:12], rtol=1e-3)
    assert np.allclose(model.basis.T @ model.basis, np.eye(12), atol=1e-9)
    # Directions well apart from those left out lie in the subspace found.
    inside = ((model.basis.T @ right[:6].T) ** 2).sum(axis=0)
    assert inside.min() > 0.99


def test_every_section_has_its_vector(spark, fitted):
    sections, rows, model = fitted
    got = {r.doc_id: np.array(r.embedding) for r in semantic.section_vectors(sections, model).collect()}
    assert got.keys() == rows.keys()
    for doc, row in rows.items():
        assert np.allclose(got[doc], row @ model.basis, atol=1e-9)


def test_blocks_of_words_do_not_matter(spark, fitted, monkeypatch):
    sections, _, model = fitted
    monkeypatch.setattr(semantic, "_AT_ONCE", 50)
    again = semantic.fit(sections.repartition(7), rank=12)
    assert np.allclose(again.singular, model.singular, rtol=1e-3)


@pytest.mark.parametrize("held", [1, 40, 1 << 21])
def test_sparse_products_equal_dense(spark, fitted, monkeypatch, held):
    """Packed or in lists, in blocks of any size, rows without words among them."""
    monkeypatch.setattr(semantic, "_HELD", held)
    sections, plain, _ = fitted
    some = sections.limit(30).unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string"))
    rows = plain_rows(spark, some)
    table = np.stack([rows[i] for i in sorted(rows)])
    right = np.random.default_rng(3).normal(size=(semantic.WIDTH, 7))
    for packed in (True, False):
        counted = semantic.counted(some, packed=packed).toArrow().combine_chunks().to_batches()
        n, df = semantic._rows_with(semantic.counted(some, packed=packed), semantic.WIDTH)
        assert n == 32 and np.array_equal(df, (table > 0).sum(axis=0))
        idf = np.log((1 + n) / (1 + df)) + 1
        total = np.zeros(right.shape)
        for batch in [b.slice(at, 9) for b in counted for at in range(0, b.num_rows, 9)]:
            for block in semantic._blocks(*batch.columns[1:], idf):
                semantic._add_gram(block, right, total)
        assert np.allclose(total, table.T @ (table @ right), atol=1e-12)


def test_products_hold_no_row_of_all_features():
    """500 texts of 30 features of their own: what is held grows with the features found."""
    found = np.arange(15_000).astype(np.uint16)
    block = semantic._Block(found, np.full(15_000, 0.5), np.arange(0, 15_001, 30))
    right, total = np.ones((semantic.WIDTH, 2)), np.zeros((semantic.WIDTH, 2))
    tracemalloc.start()
    semantic._add_gram(block, right, total)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.all(total[:15_000] == 7.5) and not total[15_000:].any()
    assert peak < 8 * 500 * 15_000 / 10


def test_hybrid_search_counts_words_once(spark, monkeypatch):
    """The words that vectors are made of: once for all sections, once for the questions."""
    seen, original = [], semantic.features
    monkeypatch.setattr(semantic, "features", lambda s, *a, **k: seen.append(s.columns) or original(s, *a, **k))
    queries.QUERIES["search_hybrid"](spark, SF_DIR)
    assert len(seen) == 2


def test_fusion_and_ties(spark):
    one = spark.createDataFrame([("q", 1, 1), ("q", 2, 2), ("q", 3, 3)], "query_id string, doc_id long, rank int")
    two = spark.createDataFrame([("q", 3, 1), ("q", 2, 2), ("q", 9, 3), ("r", 5, 1)], "query_id string, doc_id long, rank int")
    got = semantic.fused([one, two], 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.doc_id) for r in got] == [("q", 3), ("q", 2), ("q", 1), ("r", 5)]
    assert got[0].score == round(1 / 63 + 1 / 61, 12)


def test_hybrid_search_finds_words_and_relatives(spark):
    topics = {"storage": "freezer nitrogen shelf cold ambient", "transport": "truck courier road parcel driver"}
    rows = []
    for i in range(60):
        kind = list(topics)[i % 2]
        words = topics[kind].split()
        rows.append((i, " ".join(words[(i + j) % 5] for j in range(3)) + f" {kind} filler{i}", "x", "y"))
    sections = spark.createDataFrame([*rows, (100, None, "", ""), (101, "", "", "")], SCHEMA)
    model = semantic.fit(sections, rank=4)
    vectors = semantic.section_vectors(sections, model)
    asked = spark.createDataFrame([("q", "freezer shelf")], "query_id string, text string")
    found = semantic.hybrid_search(search.build_index(sections), vectors, asked, model, 12).collect()
    assert len(found) == 12 and all(r.doc_id % 2 == 0 and r.doc_id < 60 for r in found)


def test_empty_and_wordless_tables(spark):
    for rows in ([], [(1, None, "", ""), (2, " - ", "", "")]):
        sections = spark.createDataFrame(rows, SCHEMA)
        model = semantic.fit(sections)
        assert model.basis.shape[1] == 0
        assert semantic.section_vectors(sections, model).count() == len(rows)
        asked = spark.createDataFrame([("q", "word")], "query_id string, text string")
        vectors = semantic.section_vectors(sections, model)
        assert semantic.semantic_topk(vectors, asked, model, 3).count() == 0


def test_registered_vectors_cover_the_table(spark):
    vectors = queries.QUERIES["semantic_vectors"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert vectors.count() == docs.count()
    words = docs.filter(F.regexp_count("text", F.lit(search.WORD)) > 0).select("doc_id")
    norms = vectors.withColumn("norm", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    assert norms.join(words, "doc_id").filter("norm > 0").count() > 0.9 * words.count()


def test_words_are_those_of_the_search(spark):
    text = "Größe 12-A, größe"
    row = semantic.features(spark.createDataFrame([(1, text, "", "")], SCHEMA)).first()
    assert len(row.features) == len(re.findall(r"\w+", text)) and row.features[0] == row.features[3]
