from __future__ import annotations

import datetime
import math
import random

import pytest
from pricing_audit.operators import anomaly, ranges
from pyspark.sql import functions as F

POINTS = "id long, k string, q int, d date, level int"
BOXES = "k string, lo int, hi int, start date, end date, name string"
RANGES = [("q", "lo", "hi"), ("d", "start", "end")]


def day(n):
    return None if n is None else datetime.date(1970, 1, 1) + datetime.timedelta(days=n)


def plain(points, boxes, how):
    out = []
    for p in points:
        hits = [
            b for b in boxes
            if None not in (*p[1:4], *b[:5]) and p[1] == b[0] and b[1] <= p[2] <= b[2] and b[3] <= p[3] <= b[4]
        ]
        out += [(*p, *b[1:]) for b in hits]
        if not hits and how == "left":
            out.append((*p, None, None, None, None, None))
    return sorted(out, key=str)


def test_cells_cover_every_number_once(spark):
    rng = random.Random(1)
    cases = [(lo, lo + rng.randint(-2, 70)) for lo in range(-40, 40)] + [(-(2**31), 2**31 - 1), (None, 5), (3, None)]
    df = spark.createDataFrame(cases, "lo long, hi long").select("lo", "hi", ranges.cells(F.col("lo"), F.col("hi")).alias("c"))
    for lo, hi, cut in df.collect():
        if lo is None or hi is None or lo > hi:
            assert not cut
            continue
        if hi - lo < 1000:
            held = sorted(x for n, c in cut for x in range(c << 3 * n, (c + 1) << 3 * n))
            assert held == list(range(lo, hi + 1))
        assert len(cut) <= 14 * ((hi - lo + 1).bit_length() // 3 + 1)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equals_plain_ranges(spark, how):
    rng = random.Random(2)
    some = lambda x: None if rng.random() < 0.03 else x
    points = [
        (i % 380, some(rng.choice("aab")), some(rng.randint(-5, 60)), some(day(rng.randint(-30, 300))), 1)
        for i in range(400)
    ] + [(900, "a", 7, day(3), 1)] * 30
    boxes = []
    for i in range(300):
        lo, start = rng.randint(-8, 50), rng.randint(-40, 290)
        hi = rng.choice([lo, lo + rng.randint(-3, 9), 99999])
        end = rng.choice([start, start + rng.randint(-5, 200)])
        boxes.append((some(rng.choice("abc")), some(lo), some(hi), some(day(start)), some(day(end)), f"r{i % 290}"))
    got = ranges.match_boxes(
        spark.createDataFrame(points, POINTS), spark.createDataFrame(boxes, BOXES), ["k"], RANGES, how
    )
    assert got.columns == ["id", "k", "q", "d", "level", "lo", "hi", "start", "end", "name"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(points, boxes, how)


def test_empty_sides(spark):
    points, boxes = spark.createDataFrame([], POINTS), spark.createDataFrame([], BOXES)
    one = spark.createDataFrame([(1, "a", 1, day(1), 0)], POINTS)
    assert ranges.match_boxes(points, boxes, ["k"], RANGES).count() == 0
    assert ranges.match_boxes(one, boxes, ["k"], RANGES).collect()[0].name is None
    assert ranges.match_boxes(one, boxes, ["k"], RANGES, "inner").count() == 0


def test_fractions_are_refused(spark):
    points = spark.createDataFrame([(1.5, "a")], "q double, k string")
    boxes = spark.createDataFrame([(1, 2, "a")], "lo int, hi int, k string")
    with pytest.raises(TypeError):
        ranges.match_boxes(points, boxes, ["k"], [("q", "lo", "hi")])


def test_joined_rows_are_the_answer(spark):
    """A thousand overlapping versions of one key: the lookup makes no row beyond the matches."""
    start = datetime.date(2020, 1, 1)
    card = [(f"c{i:04d}", "acme", start + datetime.timedelta(days=i), start + datetime.timedelta(days=i + 3)) for i in range(1000)]
    rates = spark.createDataFrame(card, "contract_id string, customer_name string, effective_date date, expiry_date date").select(
        "*", F.lit(1).alias("volume_tier_min"), F.lit(99999).alias("volume_tier_max"), F.lit(2.5).alias("unit_price")
    )
    billing = spark.range(5000).select(
        F.col("id").alias("txn_id"), F.lit("acme").alias("customer_name"),
        F.date_add(F.lit(start), (F.col("id") % 1003).cast("int")).alias("txn_date"), (F.col("id") % 40 + 1).cast("int").alias("quantity"),
    )
    options = {"keys": ("customer_name",), "how": "inner"}
    fast = anomaly.match_rates(billing, rates, cells=True, **options)
    slow = anomaly.match_rates(billing, rates, **options)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.select(fast.columns).collect()))
    cut = ranges.cut_boxes(anomaly._rate_side(rates, ("customer_name",)), [("", "volume_tier_min", "volume_tier_max"), ("", "contract_start", "contract_end")])
    assert cut.count() <= 1000 * 6 * 14 * 4
    latest = anomaly.match_rates(billing, rates, single=True, cells=True, **options)
    expect = anomaly.match_rates(billing, rates, single=True, **options)
    assert sorted(map(tuple, latest.collect())) == sorted(map(tuple, expect.select(latest.columns).collect()))


def test_pairs_are_made_by_the_last_join(spark):
    """Two hundred versions hold for each of a thousand shipments: no shuffle carries the pairs."""
    start = datetime.date(2020, 1, 1)
    boxes = spark.range(200).select(
        F.lit("a").alias("k"), F.lit(1).alias("lo"), F.lit(9).alias("hi"), F.lit(start).alias("start"),
        F.date_add(F.lit(start), (F.col("id") % 50 + 30).cast("int")).alias("end"), F.col("id").cast("string").alias("name"),
    )
    points = spark.range(1000).select(
        "id", F.lit("a").alias("k"), (F.col("id") % 9 + 1).cast("int").alias("q"),
        F.date_add(F.lit(start), (F.col("id") % 30).cast("int")).alias("d"), F.lit(0).alias("level"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        got = ranges.match_boxes(points, boxes, ["k"], RANGES)
        assert got.count() == 200_000
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    lines = plan[plan.index("SortMergeJoin"):].splitlines()
    # Below the topmost join no other join's pairs are shuffled: boxes reach it straight from their cut.
    assert not [x for x in lines[1:] if "SortMergeJoin" in x and "Inner" in x]


def _two_lengths(rng, n, long):
    """``n`` boxes of a number and a few days; of ``long`` lengths ten boxes of many numbers each."""
    boxes = [("a" if i % 3 else "b", q, q, day(s), day(s + 5 + i % 9), f"n{i}") for i in range(n)
             for q, s in [(rng.randint(1, 20), rng.randint(0, 200))]]
    for k in range(long):
        boxes += [(rng.choice("ab"), 1, 4 ** (5 + k), day(s), day(s + 60), f"w{k}-{i}") for i in range(10) for s in [rng.randint(0, 200)]]
    return [*boxes, (None, 1, 20, day(0), day(300), "no key"), ("a", None, 20, day(0), day(300), "no bound")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_are_shuffled_once(spark):
    """Boxes of one length beside a few long ones: one shuffle of points and one of boxes, no more."""
    rng = random.Random(5)
    points = [(i, rng.choice(["a", "b", None]), rng.choice([None, *range(1, 40)]), day(rng.randint(0, 260)), 1) for i in range(500)]
    points += points[:40]
    boxes = _two_lengths(rng, 300, 2)
    left, right = spark.createDataFrame(points, POINTS), spark.createDataFrame(boxes, BOXES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        for how in ("left", "inner"):
            got = ranges.match_boxes(left, right, ["k"], RANGES, how)
            assert sorted(map(tuple, got.collect()), key=str) == plain(points, boxes, how)
            assert _plan(got).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("long, limit", [(0, 0), (2, 0), (9, ranges.BROADCAST_BYTES)])
def test_levels_too_many_or_too_large_to_send(spark, long, limit):
    rng = random.Random(6)
    points = [(i, rng.choice(["a", "b", None]), rng.choice([None, *range(1, 60)]), day(rng.randint(-9, 260)), 1) for i in range(300)]
    boxes = _two_lengths(rng, 200, long)
    left, right = spark.createDataFrame(points, POINTS), spark.createDataFrame(boxes, BOXES)
    for how in ("left", "inner"):
        got = ranges.match_boxes(left, right, ["k"], RANGES, how, limit=limit)
        assert sorted(map(tuple, got.collect()), key=str) == plain(points, boxes, how)


def test_levels_are_exact_beside_powers(spark):
    sizes = sorted({n for k in range(33) for n in (2**k - 1, 2**k, 2**k + 1) if n < 2**32})
    boxes = spark.createDataFrame([(-(2**31), n - 2**31) for n in sizes], "lo int, hi int")
    want = {n: 0 if not n else math.ceil(n.bit_length() / ranges.SIZE_BITS) for n in sizes}
    got = boxes.select((F.col("hi").cast("long") - F.col("lo")).alias("n"), ranges._levels(boxes, [("", "lo", "hi")])["__level0"].alias("l"))
    assert {r.n: r.l for r in got.collect()} == want


def test_levels_merge_upwards_once():
    assert ranges._merged([(0, 2), (0, 3), (9, 5)]) == {(9, 5): (9, 5), (0, 3): (0, 3), (0, 2): (0, 3)}
    # Levels in a row: every other one stays, so that no box goes up more than one level.
    assert ranges._merged([(0,), (1,), (2,), (3,)]) == {(3,): (3,), (2,): (3,), (1,): (1,), (0,): (1,)}


@pytest.mark.parametrize("date", ["txn_date", None])
def test_a_choice_sees_equal_ranges_once(spark, date, monkeypatch):
    """Fifty amendments of one range: the one that wins is found before they meet any transaction."""
    rates = [("a", f"c{i:02}", 10.0 + i, 1, 9, day(5), day(20 if date else 20 + i)) for i in range(50)]
    rates += [("a", "old", 1.0, 1, 9, day(1), day(20)), ("b", None, 2.0, 1, 9, day(5), day(20))]
    card = spark.createDataFrame(
        rates, "k string, contract_id string, unit_price double, volume_tier_min int, volume_tier_max int, "
        "effective_date date, expiry_date date")
    billing = spark.createDataFrame(
        [(1, "a", 3, day(7)), (2, "a", 3, day(2)), (3, "a", 30, day(7)), (4, "b", 3, day(7)), (5, None, 3, None)],
        "id long, k string, quantity int, txn_date date")
    seen, original = [], anomaly.match_boxes

    def watched(points, boxes, *args, **kwargs):
        seen.append(boxes.count())
        return original(points, boxes, *args, **kwargs)

    monkeypatch.setattr(anomaly, "match_boxes", watched)
    got = anomaly.match_rates(billing, card, ["k"], date=date, single=True, cells=True).orderBy("id").collect()
    early = None if date is None else "old"
    assert [(r.id, r.contract_id, r.contract_unit_price) for r in got] == [
        (1, "c00", 10.0), (2, early or "c00", 1.0 if early else 10.0), (3, None, None), (4, None, 2.0), (5, None, None)]
    assert seen == [3 if date else 2]
