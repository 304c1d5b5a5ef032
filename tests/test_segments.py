from __future__ import annotations

import math
import random

import pytest
from pricing_audit.operators import search, segments
from pricing_audit.session import scratch_path
from pricing_audit.streaming import jobs

SCHEMA = "doc_id long, text string, lang string, removed boolean"
WORDS = "price rate tier volume storage freezer ambient shelf courier parcel".split()


def batch_of(rng, live, n):
    """Random changes, and what is live after them."""
    rows = {}
    for _ in range(n):
        doc = rng.randrange(60)
        if rng.random() < 0.3:
            rows[doc] = (doc, None, None, True)
        else:
            rows[doc] = (doc, " ".join(rng.choices(WORDS, k=rng.randint(0, 9))), rng.choice(["en", "de"]), False)
    for doc, row in rows.items():
        if row[3]:
            live.pop(doc, None)
        else:
            live[doc] = row
    return list(rows.values())


def found(spark, index, filters=None):
    asked = spark.createDataFrame([(i, f"{w} {v}") for i, (w, v) in enumerate(zip(WORDS, WORDS[3:], strict=False))], "query_id int, text string")
    return sorted(map(tuple, search.search(index, asked, 5, filters).collect()))


def test_any_order_of_changes_equals_a_fresh_index(spark):
    rng, live = random.Random(1), {}
    index = segments.SegmentedIndex(spark, scratch_path(spark, "segments"), ("lang",))
    for number, n in enumerate([30, 2, 5, 1, 12, 3]):
        rows = batch_of(rng, live, n)
        changes = spark.createDataFrame(rows, SCHEMA)
        index.apply(changes, number)
        sizes = [s.sections for s in index.segments()]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
        assert len(sizes) <= math.log2(max(sizes[0], 1)) + 1
    fresh = search.build_index(spark.createDataFrame(list(live.values()), SCHEMA), attributes=("lang",))
    assert found(spark, index.index()) == found(spark, fresh)
    assert found(spark, index.index(), {"lang": "de"}) == found(spark, fresh, {"lang": "de"})
    before = index.segments()
    index.apply(changes, number)  # a replay
    assert index.segments() == before


def test_repeated_rows_of_a_batch_and_empty_batches(spark):
    index = segments.SegmentedIndex(spark, scratch_path(spark, "segments"))
    with pytest.raises(ValueError):
        index.index()
    rows = [(1, "old price", 1, False), (1, "new rate", 2, False), (1, None, 0, True), (2, "tier", 1, False), (2, None, 2, True), (None, "shelf", 1, False)]
    schema = "doc_id long, text string, at int, removed boolean"
    index.apply(spark.createDataFrame(rows, schema), 3, order="at")
    index.apply(spark.createDataFrame([], schema), 4, order="at")
    live = {r.doc_id for r in index.index().docs.collect()}
    assert live == {1, None}
    terms = {(r.doc_id, r.term) for r in index.index().postings.collect()}
    assert {t for d, t in terms if d == 1} == {"new", "rate"}


def test_stream_equals_a_fresh_index(spark):
    root, rng, live = scratch_path(spark, "segments"), random.Random(2), {}

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        jobs.stream_segments(stream, f"{root}/index", f"{root}/checkpoint").awaitTermination()

    for n in (20, 6):
        spark.createDataFrame(batch_of(rng, live, n), SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        run()
    fresh = search.build_index(spark.createDataFrame(list(live.values()), SCHEMA))
    got = segments.SegmentedIndex(spark, f"{root}/index").index()
    assert found(spark, got) == found(spark, fresh)
