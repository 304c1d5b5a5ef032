from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from brute import word_counts
from tables import documents as documents
from pricing_audit.llm import gru, lm

SF = "/root/testdata/sf0.01"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def check(rows, got):
    tokens, counts = word_counts(rows, lambda i: not held(i))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for r in got:
        words = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (r.n_tokens, r.n_known) == (len(words), sum(counts[w] > 0 for w in words))
        assert r.train_tokens == n and r.held_out == held(r.doc_id)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r.score < 0 or n == 0


@pytest.mark.parametrize("frequent", [0, 300, 150_000])
def test_base_scores_equal_plain_counts(spark, documents, frequent, monkeypatch):
    """Whatever the number of words that are sent to the tasks."""
    monkeypatch.setattr(lm, "FREQUENT_WORDS", frequent)
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 150")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(1000, None), (1001, ""), (1002, " a\x1cb  Ärger\n"), (1003, "neverseen " * 3000)]
    check(rows, lm.score_documents(documents(rows)).collect())


def test_better_than_the_base_on_unseen_texts(spark):
    got = lm.score_documents(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > 0.97 * sum(r.base_score for r in unseen)


def test_every_training_text_is_learnt(spark, documents, monkeypatch):
    """Also where the corpus has far more than 16 million tokens."""
    rows = [(i, f"w{i % 7} " * 5) for i in range(200)] + [(None, "no id"), (500, "a b " * 4000)]
    docs = documents(rows)
    words, _ = lm.vocabulary(lm.word_counts(docs))
    kept = []
    monkeypatch.setattr(lm, "stage", lambda rows, name: kept.append(rows.cache()) or kept[-1])
    tokens, words.tokens = words.tokens, 1 << 25
    lm.train(docs, words)
    lengths = sorted(len(r.ids) // 2 for r in kept[0].collect())
    assert lengths == sorted(len(text.split()) + 1 for i, text in rows if not held(i)) and sum(lengths) == tokens


def test_training_sees_every_token():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, gru.TOKENS, n) for n in rng.integers(1, 200, 300)]
    m = model()
    assert gru.train(m, gru.fresh_speed(m), iter(docs)) == sum(map(len, docs))


def test_no_training_text_and_empty_table(documents):
    only = next(i for i in range(100) if held(i))
    rows = lm.score_documents(documents([(only, "some words"), (only, None)])).collect()
    assert [(r.train_tokens, r.n_known, r.base_score) for r in rows] == [(0, 0, 0.0)] * 2
    assert all(math.isfinite(r.score) for r in rows)
    assert lm.score_documents(documents([])).count() == 0


def model(seed=0):
    rng = np.random.default_rng(seed)
    made = gru.start_model(rng.integers(1, 50, gru.HEAD), rng.integers(1, 50, gru.TAIL_CLASSES).astype(float))
    return {k: v + rng.normal(0, 0.2, v.shape).astype(np.float32) for k, v in made.items()}


def plain_score(m, ids):
    """One token at a time, in double precision."""
    m = {k: v.astype(float) for k, v in m.items()}
    h, total = np.zeros(gru.HIDDEN), 0.0
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for i in ids:
        logits = h @ m["class_w"] + m["class_b"]
        c = i // gru.CLASS_WORDS if i < gru.HEAD else i - gru.HEAD + gru.HEAD_CLASSES
        total += logits[c] - np.log(np.exp(logits).sum())
        if i < gru.HEAD:
            logits = h @ m["word_w"][c] + m["word_b"][c]
            total += logits[i % gru.CLASS_WORDS] - np.log(np.exp(logits).sum())
        x, past = m["read"][i], h @ m["keep"]
        n = gru.HIDDEN
        z, r = sigmoid(x[:n] + past[:n]), sigmoid(x[n : 2 * n] + past[n : 2 * n])
        h = (1 - z) * np.tanh(x[2 * n :] + r * past[2 * n :]) + z * h
    return total


def test_scores_carry_state_over_windows():
    rng = np.random.default_rng(1)
    m = model()
    docs = [rng.integers(0, gru.TOKENS, n) for n in (1, 5, gru.WINDOW, gru.WINDOW * 3 + 7, 2)]
    assert gru.score(m, docs) == pytest.approx([plain_score(m, d) for d in docs], rel=1e-4)
    assert gru.score(m, docs[:1]) == pytest.approx([plain_score(m, docs[0])], rel=1e-4)


def test_probabilities_add_up_to_one():
    m = model()
    first = [np.array([i]) for i in range(gru.TOKENS)]
    assert np.exp(gru.score(m, first)).sum() == pytest.approx(1, rel=1e-3)


def test_gradients(monkeypatch):
    """One step against numerical differences of the loss."""
    rng = np.random.default_rng(3)
    m = {k: v.astype(np.float64) for k, v in model(5).items()}
    ids = rng.integers(0, gru.TOKENS, (6, 3))
    first = np.zeros((6, 3), bool)
    first[0] = True
    first[3, 1] = True
    real = np.ones((6, 3), bool)
    real[4:, 2] = False
    ids[~real] = -1

    def loss(m):
        h, total = np.zeros((3, gru.HIDDEN)), 0.0
        for t in range(6):
            h = np.where(first[t][:, None], 0, h)
            p, _ = gru._predict(m, h[real[t]], ids[t][real[t]])
            total -= p.sum()
            h, _ = gru._step(m, h, m["read"][np.maximum(ids[t], 0)])
        return total / real.sum()

    monkeypatch.setattr(gru, "MOST_GRADIENT", 1e9)
    monkeypatch.setattr(gru, "STEP", 1.0)
    after = {k: v.copy() for k, v in m.items()}
    speed = {k: np.full_like(v, 1e12) for k, v in m.items()}  # the step is then gradient / 1e6
    gru._window(after, speed, ids, first, real, np.zeros((3, gru.HIDDEN)))
    for name in m:
        gradient = (m[name] - after[name]) * 1e6
        for at in np.argsort(-np.abs(gradient), axis=None)[:4]:
            at = np.unravel_index(at, m[name].shape)
            up, down = ({k: v.copy() for k, v in m.items()} for _ in range(2))
            up[name][at] += 1e-4
            down[name][at] -= 1e-4
            assert (loss(up) - loss(down)) / 2e-4 == pytest.approx(gradient[at], rel=0.02, abs=1e-5), name
