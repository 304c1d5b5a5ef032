from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from conftest import SF_DIR
from pricing_audit.llm import periodic
from pricing_audit.llm.queries import QUERIES
from tables import documents  # noqa: F401


def plain_runs(w):
    """Every period by itself: maximal stretches of equal words one period apart."""
    found = []
    for p in range(1, len(w) // 2 + 1):
        k = 0
        while k < len(w) - p:
            if w[k] != w[k + p]:
                k += 1
                continue
            s = k
            while k < len(w) - p and w[k] == w[k + p]:
                k += 1
            n = k - s + p
            seg = w[s : s + n]
            if n >= max(12, 2 * p) and not any(seg[q:] == seg[: n - q] for q in range(1, p)):
                found.append((s, n, p))
    return sorted(found)


def plain_row(doc_id, text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = plain_runs(w)
    kept = [x for i, x in enumerate(w) if not any(s + p <= i < s + n for s, n, p in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    long = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *long, digest(listed), digest(" ".join(kept)))


def words(rng):
    n, kinds = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5, 20])
    w = [b"%d" % rng.randrange(kinds) for _ in range(n)]
    if n > 4 and rng.random() < 0.5:
        a, p = rng.randrange(n), rng.randint(1, n // 2)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_automaton_and_stretches_equal_plain_runs():
    rng = random.Random(1)
    for _ in range(1500):
        texts = [(i, words(rng)) for i in range(3)]
        for (doc_id, w), got in zip(texts, periodic._decided(texts), strict=True):
            runs = plain_runs(w)
            assert periodic.runs_of(w) == runs
            assert got == periodic.result(doc_id, w, runs)


def test_known_runs():
    assert periodic.runs_of([b"a"] * 12) == [(0, 12, 1)]
    assert periodic.runs_of([b"a"] * 11) == []
    half = [b"%d" % i for i in range(9)]
    assert periodic.runs_of([b"x", *half, *half, b"0", b"y"]) == [(1, 19, 9)]
    inner = [b"a"] * 12 + [b"b"]  # runs within a run
    assert periodic.runs_of(inner + inner) == [(0, 12, 1), (0, 26, 13), (13, 12, 1)]


def test_whole_table_equals_plain(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        if len((text or "").split()) <= 600:
            assert got[doc_id] == plain_row(doc_id, text)


def test_odd_rows(spark, documents):
    line = " ".join(f"w{i}" for i in range(30))
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, f"{line}\n{line}\x0b{line}"), (4, f"{line}\n{line}\x0b{line}"),
        (None, f"{line} {line}"), (None, "x " * 40), (7, "é " * 12), (8, "a b " * 12), (9, "one"),
    ] + [(i, f"{line} tail {i} " * 2) for i in range(20, 60)]
    got = periodic.periodic_runs(documents(rows).withColumnRenamed("label", "start"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_row(*r) for r in rows), key=str)


def test_long_text_and_many_blocks(spark, documents, monkeypatch):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(50)}" for _ in range(200_000))
    got = {r.doc_id: r for r in periodic.periodic_runs(documents([(1, long), (5, "a b c " * 100_000)])).collect()}
    assert (got[5].n_runs, got[5].length, got[5].period) == (1, 300_000, 3)
    assert got[1].collapsed_sha256 == hashlib.sha256(long.encode()).hexdigest()


def test_empty_table(spark, documents):
    assert periodic.periodic_runs(documents([])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 13])
def test_tail_of_short_texts(n):
    for doc_id in range(200):
        w = [b"%d" % i for i in range(n)]
        assert len(periodic.repeat_tail(w, doc_id)) == n
