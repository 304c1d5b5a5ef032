from __future__ import annotations

import collections
import hashlib
import random
import re

from brute import near_groups
from tables import documents as documents
from pricing_audit.llm import components, exact_stream, jaccard, shingles
from pricing_audit.session import scratch_path
from pyspark.sql import functions as F


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[normal(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [
    (4, "a  b"), (2, "a\tb"), (7, "a b "), (8, None), (3, ""), (9, " \n"), (11, " "), (12, "é\xa0x"), (13, "é x"),
    (None, "a b"), (None, "only null"), (20, "same"), (20, "same"), (21, "x" * 200_000), (22, "x" * 200_000),
]


def test_exact_groups(documents):
    rows = exact_stream.exact_duplicates(documents(ROWS)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == plain(ROWS)
    kept = collections.Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_colliding_digests_are_told_apart(documents):
    """One hexadecimal digit as digest: nearly every hit has other bytes."""
    rng = random.Random(1)
    rows = [(i, f"text {rng.randint(0, 60)}") for i in range(300)]
    weak = lambda text: F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(text, 256), 1, 1)))
    got = exact_stream.exact_duplicates(documents(rows), digest=weak).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == plain(rows)
    assert sum(r.kept for r in got) == len({t for _, t in rows})


def test_state_goes_on_over_batches(spark, documents):
    """A later batch finds the earlier texts in the state, and can lower the smallest id."""
    state = scratch_path(spark, "state-test")
    spark.createDataFrame([], exact_stream.GROUPS).write.parquet(f"{state}/groups/batch=-1")
    for rows in ([(5, "x"), (6, "y")], [(1, "x"), (9, "y")], [(7, "z")]):
        docs = exact_stream.located(documents(rows))
        docs.select(
            "doc_id", exact_stream.sha256(exact_stream.normalised()).alias("digest"),
            F.col("__file").alias("file"), F.col("__row").alias("row"),
        ).coalesce(1).write.mode("append").parquet(f"{state}/fingerprints")
        exact_stream.update_state(spark, f"{state}/fingerprints", state, per_batch=1)
    groups = exact_stream.latest_groups(spark, state).select("size", "keep.doc_id").collect()
    assert sorted(tuple(r) for r in groups) == [(1, 7), (2, 1), (2, 6)]


def test_rows_that_stay_have_all_columns(spark, documents):
    docs = documents(ROWS)
    stay = exact_stream.without_duplicates(docs)
    assert stay.columns == docs.columns
    assert stay.count() == len({normal(t) for _, t in ROWS})
    path = scratch_path(spark, "from-files")
    docs.write.parquet(path)
    assert exact_stream.without_duplicates(spark.read.parquet(path)).count() == stay.count()
    assert exact_stream.without_duplicates(docs.limit(0)).count() == 0


def copies(rng, n):
    """Near copies around a few texts, short texts, and a passage in all of them."""
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=30))
    rows = []
    for i in range(n):
        if i % 3 == 0 or not rows:
            text = rng.choices(words, k=rng.randint(20, 80))
        else:
            text = rows[rng.randrange(len(rows))][1].split(" ")
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(n + i, f"{passage} {' '.join(rng.choices(words, k=10))}") for i in range(20)]
    rows += [(n + 30, "one"), (n + 31, "ONE\t"), (n + 32, "one two"), (n + 33, None), (n + 34, " "), (n + 35, "one two")]
    return rows


def test_near_groups_equal_brute_force(documents):
    rows = copies(random.Random(5), 150)
    docs = documents(rows)
    for k, percent in ((3, 90), (5, 80), (2, 50)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, k, percent).collect()}
        assert got == near_groups(rows, k, percent)


def test_near_groups_with_odd_rows(documents):
    text = "a b c d e f g h i j k l"
    rows = [(3, text), (3, text), (None, text), (1, text + " m"), (None, "q"), (None, None), (8, "word " * 60_000), (9, "word " * 60_001)]
    got = jaccard.near_duplicates(documents(rows), 3, 80).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.n_shingles in (10, 11)} == {1}
    assert {r.component_id for r in got if r.doc_id in (8, 9)} == {8}
    stay = jaccard.one_per_group(documents(rows), 3, 80).collect()
    assert sorted((r.doc_id for r in stay), key=str) == [1, 8, None, None]
    assert jaccard.near_duplicates(documents([]), 3, 80).count() == 0


def test_one_row_per_group_whatever_the_ids(documents):
    text = "a b c d e f g h i j k l"
    rows = [(None, text), (None, text + " m"), (None, None)]
    rows += [(4, f"w {text} {end}") for end in ("x", "y", "z")] + [(7, "p q r s"), (7, "p q r s")]
    stay = jaccard.one_per_group(documents(rows), 3, 60).collect()
    assert sorted((r.doc_id for r in stay if r.text and r.text.startswith("p"))) == [7]
    assert len([r for r in stay if r.text and not r.text.startswith("p")]) == 1  # one linked group
    assert [r.doc_id for r in stay if r.text is None] == [None]
    only = jaccard.one_per_group(documents(rows[:3]), 3, 80).collect()
    assert sorted((r.text for r in only), key=str) in ([None, text], [None, text + " m"])


def test_shingles_equal_plain_sets():
    rng = random.Random(2)
    texts = [
        b" ".join(rng.choice([b"a", b"B", b"c\x85", b"dd\x1c", b""]) + rng.choice([b"", b"\n", b"\t"]) for _ in range(rng.randint(0, 30)))
        for _ in range(1500)
    ] + [b"ab cd " * 100_000, b"z" * 300_000]
    seen = {}
    for text, found in zip(texts, shingles.shingle_sets(texts, 3), strict=True):
        words = re.findall(rb"[^\x20\x09-\x0D]+", text.lower())
        want = {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} - {()}
        assert len(found) == len(want)
        assert seen.setdefault(frozenset(want), found.tobytes()) == found.tobytes()
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 40)] + [(7, 7), (201, 200), (200, 201)]
    edges = spark.createDataFrame([*chain, (None, 3)], "u long, v long")
    got = {r.node: r.label for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
    assert components.connected_components(edges.limit(0)).count() == 0


def test_changed_copies_of_one_text_open_no_pairs(spark, documents, monkeypatch):
    opened = []
    real = jaccard.open_pairs

    def counted(listed, percent):
        pairs = real(listed, percent)
        opened.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "open_pairs", counted)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    rows = [(900, " ".join(base))]
    for i in range(400):
        w = list(base)
        for p in rng.sample(range(200), 3):
            w[p] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    found = jaccard.near_duplicates(documents(rows), 5, 80).collect()
    assert {r.component_id for r in found} == {0} and opened == [0]
