from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import pytest
from brute import water
from pricing_audit.llm import mixing


def plain(rows, plan):
    docs = []
    for i, text, lang, source in rows:
        lang, source, text = lang or "", source or "", text or ""
        key = str(i) if i is not None else "text " + hashlib.md5(text.encode()).hexdigest()
        domain = f"d{zlib.crc32(source.encode()) % plan.domains}"
        docs.append((i, domain, lang, source, len(re.findall(r"[^\x20\x09-\x0D]+", text)), key))
    tokens = collections.Counter()
    for d in docs:
        tokens[d[1:4]] += d[4]
    weight = lambda level, name: plan.weights.get(level, {}).get(name, 1)
    cap = {k: v * plan.most_epochs for k, v in tokens.items()}
    given = {(): min(sum(tokens.values()) * plan.budget // 1_000_000, sum(cap.values()))}
    for depth, level in enumerate(mixing.LEVELS, 1):
        for parent in [p for p in given if len(p) == depth - 1]:
            names = sorted({k[depth - 1] for k in tokens if k[: depth - 1] == parent})
            caps = {n: sum(v for k, v in cap.items() if k[:depth] == (*parent, n)) for n in names}
            for n, g in water(names, {n: weight(level, n) for n in names}, caps, given[parent]).items():
                given[(*parent, n)] = g
    out = []
    for leaf, total in tokens.items():
        epochs, rest = divmod(given[leaf], total) if total else (0, 0)
        places = collections.Counter()
        place = lambda key: int(hashlib.md5(f"{plan.seed}|{epochs}|{key}".encode()).hexdigest()[:15], 16)  # noqa: E731, B023
        own = [d for d in docs if d[1:4] == leaf]
        for d in own:
            places[place(d[5])] += d[4]
        cut, run = -1, 0
        for p in sorted(places) if rest else []:
            run += places[p]
            if run > rest:
                break
            cut = p
        out += [(*d[:5], epochs + (place(d[5]) <= cut)) for d in own]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    made = []
    for i in range(400):
        source = rng.choice(["src0"] * 6 + [f"src{n}" for n in range(8)] + [None])
        made.append((i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None]), source))
    return made + [(5, "again five", "en", "src0"), (None, "no id", "en", "src1"), (None, "no id", "en", "src1"), (900, None, "xx", "empty")]


@pytest.mark.parametrize(
    "plan",
    [
        mixing.DEFAULT, mixing.Plan(budget=0), mixing.Plan(budget=5_000_000, most_epochs=3),
        mixing.Plan(budget=1_500_000, most_epochs=2, weights={"lang": {"de": 9}, "source": {"src0": 5}}),
    ],
)
def test_equals_plain_filling(spark, rows, plan, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKETS", 16)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sorted((tuple(r) for r in mixing.mix(docs, plan).collect()), key=str)
    assert got == plain(rows, plan)
    spent = sum(r[4] * r[5] for r in got)
    total = sum(r[4] for r in got)
    assert spent <= total * plan.budget // 1_000_000


def test_documents_come_as_often_as_chosen(spark, rows):
    plan = mixing.Plan(budget=1_500_000)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, source string, epochs int, cut string")
    mixed = mixing.mixed_documents(docs, plan)
    assert mixed.columns == docs.columns
    chosen = collections.Counter()
    for r in plain(rows, plan):
        chosen[r[0]] += r[5]
    assert collections.Counter(r.doc_id for r in mixed.collect()) == +chosen


def test_empty_table_and_bad_weights(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert mixing.mix(docs).count() == 0 and mixing.mixed_documents(docs).count() == 0
    with pytest.raises(ValueError):
        mixing.Plan(weights={"lang": {"en": 0}})
