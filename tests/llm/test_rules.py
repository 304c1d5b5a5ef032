from __future__ import annotations

import collections
import random
import re

import pytest
from conftest import SF_DIR
from conftest_sql import compare_with_sql
from pricing_audit.llm import rules
from pricing_audit.llm.oracle import ORACLE
from pricing_audit.llm.queries import QUERIES

SPACE = r"[\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, key string, lines string, __row int"


def split(text):
    return [w for w in re.split(SPACE, text) if w]


def normal(line):
    return re.sub("[0-9]", "0", re.sub(SPACE, " ", line).strip(" ")).translate(
        {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
    )


def plain(rows, limit):
    texts = collections.defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if split(line):
                texts[source, normal(line)].add(text)
    out = []
    for doc_id, text, source in rows:
        text = text or ""
        w = split(text)
        lines = [x for x in text.split("\n") if split(x)]
        seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        held = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        lost = sum(len(split(x)) for x in lines if len(texts[source, normal(x)]) > limit)
        failed = len(w) < 50 or 100 * len(held) > 50 * len(w)
        out.append((
            doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(held), failed, not failed and 2 * lost <= len(w), lost,
        ))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcXYZé1#&") for _ in range(rng.randint(1, 5)))
    common = [" ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(8)]
    made = []
    for i in range(300):
        lines = [" ".join(word() for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(0, 6))]
        lines += rng.choices(common, k=rng.randint(0, 4))
        rng.shuffle(lines)
        made.append((i, rng.choice(["\n", " \n\t", "\n\n"]).join(lines), rng.choice(["a", "a", "b", None, "no host"])))
    odd = [
        (400, None, "a"), (401, "", "a"), (402, " \n\x0b\t\n", "a"), (403, "one", "a"), (404, "p q", "a"),
        (405, "x " * 60, "b"), (406, "x y z " * 30, "b"), (7, "again " * 3, "a"), (7, "again " * 3, "a"),
        (None, common[0] + "\n" + " ".join(str(n) for n in range(60)), "a"), (None, None, None),
        (407, "word " + " " * 3 + "\x85 wide " * 30, "a"), (408, "w" * 300_000, "a"),
        (409, " ".join(f"w{n % 5000}" for n in range(30_000)), "a"),
    ]
    return made + odd + [(500 + i, "only line " + common[1], "copies") for i in range(40)]


@pytest.mark.parametrize("limit", [2, 10])
def test_equals_plain(spark, rows, limit):
    docs = spark.createDataFrame([(i, t, "en", s, "k", "l", 1) for i, t, s in rows], SCHEMA).repartition(5)
    got = rules.judge_documents(docs, limit=limit)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, limit)


def test_clean_documents(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", s, "k", "l") for i, t, s in rows], SCHEMA.replace(", __row int", ""))
    verdict = plain(rows, 2)
    cleaned = rules.clean_documents(docs, limit=2)
    assert cleaned.columns == docs.columns
    texts = collections.defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            texts[source, normal(line)].add(text)
    expect = []
    kept = collections.Counter((v[0], v[1], v[2]) for v in verdict if v[7])
    for i, text, source in rows:
        w = split(text or "")
        if (i, len(w), sum(map(len, w))) in kept:
            left = [x for x in text.split("\n") if not split(x) or len(texts[source, normal(x)]) <= 2]
            expect.append((i, "\n".join(left)))
    assert expect and sorted(((r.doc_id, r.text) for r in cleaned.collect()), key=str) == sorted(expect, key=str)


def test_copies_alone_are_no_boilerplate(spark):
    line = " ".join(f"w{n}" for n in range(60))
    same = [(i, line, "en", "a", "", "", 0) for i in range(50)]
    docs = spark.createDataFrame(same, SCHEMA)
    assert rules.judge_documents(docs).filter("kept").count() == 50
    varied = [(i, f"{line}\nown {i}", "en", "a", "", "", 0) for i in range(11)]
    docs = spark.createDataFrame(varied, SCHEMA)
    assert rules.judge_documents(docs).filter("kept").count() == 0
    assert rules.judge_documents(docs.limit(10)).filter("kept").count() == 10


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    verdict = rules.base_rules(docs)
    plan = verdict._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_against_sql(spark):
    got, expect = compare_with_sql(
        spark, SF_DIR, "op12_line_rules", QUERIES["op12_line_rules"], ORACLE["op12_line_rules"]
    )
    assert got == expect


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert rules.judge_documents(docs).count() == 0
    assert rules.clean_documents(docs.drop("__row")).count() == 0
