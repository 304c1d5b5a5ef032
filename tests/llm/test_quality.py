from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tables import documents as documents
from pricing_audit.llm import quality

SF = "/root/testdata/sf0.1"


def test_tables_add_up_to_the_score():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)  # no single feature tells
    model = quality.fit(x, y)
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.9
    one = x[:1]
    total = model.base + sum(t[np.searchsorted(c, v, "right")] for c, t, v in zip(model.cuts, model.tables, one[0], strict=True))
    bins = model.bins(one)[0]
    total += sum(g[model.coarse[i][bins[i]], model.coarse[j][bins[j]]] for (i, j), g in zip(model.pairs, model.grids, strict=True))
    assert model.margin(one)[0] == pytest.approx(total)
    assert (0, 1) in [tuple(sorted(p)) for p in model.pairs]


def test_degenerate_training():
    none = np.zeros((0, len(quality.FEATURES)))
    assert quality.fit(none, np.zeros(0)).score(np.zeros((1, len(quality.FEATURES))))[0] == 0.5
    same = np.zeros((10, len(quality.FEATURES)))
    assert quality.fit(same, np.ones(10)).score(same)[0] > 0.9
    assert quality.fit(same, np.arange(10) % 2).score(same)[0] == pytest.approx(0.5, abs=0.01)


def test_features_of_odd_texts():
    rows = quality.features([b"", b" \n ", b"a", b"A!! B!!", b"x y " * 100_000, "é".encode()])
    assert np.isfinite(rows).all() and rows.shape == (6, len(quality.FEATURES))
    assert (rows[0] == 0).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good = [p for p, t in held if t == 1]
    bad = [p for p, t in held if t == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.05


def test_labels_of_held_out_rows_do_not_matter(spark, documents):
    rng = random.Random(2)
    text = lambda good: " ".join(rng.choice(["one", "two", "three"]) + ("" if good else "!!") for _ in range(60))
    rows = [(i, text(i % 4 > 0)) for i in range(200)]
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    one = spark.createDataFrame([(i, int(i % 4 > 0)) for i, _ in rows], "doc_id long, quality int")
    two = spark.createDataFrame([(i, 0 if held(i) else int(i % 4 > 0)) for i, _ in rows], "doc_id long, quality int")
    docs = documents(rows)
    got = [sorted((r.doc_id, r.score) for r in quality.score_documents(docs, x).collect()) for x in (one, two)]
    assert got[0] == got[1]


def test_nulls_repeats_and_empty(spark, documents):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (None, 1), (3, None), (5, 1)], "doc_id long, quality int"
    )
    docs = documents([(1, "a b"), (1, "a b"), (2, None), (None, "c"), (3, ""), (5, "d")])
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == 6 and all(r.score is not None for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert quality.score_documents(docs, labels.limit(0)).filter("score = 0.5").count() == 6
    assert quality.score_documents(docs.limit(0), labels).count() == 0
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
