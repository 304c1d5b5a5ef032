from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pytest
from pricing_audit.operators import windows
from pricing_audit.session import scratch_path
from pricing_audit.streaming import event_time
from pyspark.sql import functions as F

SCHEMA = "k string, at long, value double, begin string"
KINDS = [windows.Sliding(("k",), 30, 10), windows.Sliding(("k",), 7, 7), windows.Sessions(("k",), 9)]


def plain(rows, kind):
    groups = {}
    rows = [r for r in rows if r[1] is not None]
    if isinstance(kind, windows.Sliding):
        for k, at, value, _ in rows:
            for begin in range(at - at % kind.slide, at - kind.width, -kind.slide):
                groups.setdefault((k, begin), []).append((at, value))
    else:
        last = {}
        for k, at, value, _ in sorted(rows, key=lambda r: r[1]):
            if k not in last or at >= last[k][0] + kind.gap:
                last[k] = (at, (k, at))
            last[k] = (at, last[k][1])
            groups.setdefault(last[k][1], []).append((at, value))
    lead = (lambda g: g) if isinstance(kind, windows.Sliding) else (lambda g: g[:1])
    return sorted(
        ((*lead(g), min(a for a, _ in x), max(a for a, _ in x), len(x),
          sum((Decimal(str(v)) for _, v in x if v is not None), Decimal(0))) for g, x in groups.items()), key=str)


def found(df, kind):
    return sorted((tuple(r[c] if c != "total" else r[c].normalize() + 0 for c in kind.columns) for r in df.collect()), key=str)


def normal(rows):
    return sorted(((*r[:-1], r[-1].normalize() + 0) for r in rows), key=str)


def random_rows(rng, n, low=-200, high=200):
    some = lambda x: None if rng.random() < 0.05 else x
    return [(some(rng.choice("abc")), some(rng.randrange(low, high)), some(rng.randint(-50, 50) / 4), "x") for _ in range(n)]


@pytest.mark.parametrize("kind", KINDS)
def test_windows_equal_plain_ones(spark, kind):
    rows = random_rows(random.Random(1), 150)
    rows += rows[:10]
    assert found(windows.event_windows(spark.createDataFrame(rows, SCHEMA), kind), kind) == normal(plain(rows, kind))
    assert windows.event_windows(spark.createDataFrame([], SCHEMA), kind).count() == 0


@pytest.mark.parametrize("kind", [KINDS[0], KINDS[2]])
def test_stream_equals_the_windows_of_rows_in_time(spark, kind):
    rng, path = random.Random(2), scratch_path(spark, "windows")
    accepted, late, mark, delay = [], [], None, 25
    for number in range(5):
        rows = random_rows(rng, 40, 100 * number - 60, 100 * number + 60) if number != 3 else []
        for r in rows:
            (late if r[1] is None or (mark is not None and r[1] < mark) else accepted).append(r)
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        event_time.stream_windows(stream, kind, f"{path}/out", f"{path}/checkpoint", delay).awaitTermination()
        times = [r[1] - delay for r in rows if r[1] is not None]
        mark = max(times if mark is None else [mark, *times])
        got = event_time.current_windows(spark, f"{path}/out", kind)
        assert found(got, kind) == normal(plain(accepted, kind))
        for r in got.collect():
            end = r["begin"] + kind.width if isinstance(kind, windows.Sliding) else r["last"] + kind.gap
            assert r["closed"] == (end <= mark)
    kept = event_time.late_rows(spark, f"{path}/out").select("k", "at", "value", "begin").collect()
    assert late and sorted(map(str, map(tuple, kept))) == sorted(map(str, late))


def test_a_replayed_batch_changes_nothing(spark):
    kind, path = KINDS[2], scratch_path(spark, "windows-replay")
    rows = random_rows(random.Random(3), 60)
    held = {}

    class Stream:  # hands the batch function back instead of running it
        @property
        def writeStream(self):
            return self

        def foreachBatch(self, handle):
            held["add"] = handle
            return self

        def option(self, *_):
            return self

        def trigger(self, **_):
            return self

        def start(self):
            return None

    event_time.stream_windows(Stream(), kind, path, "unused", 20)
    parts = [spark.createDataFrame(rows[i : i + 20], SCHEMA) for i in (0, 20, 40)]
    for number in (0, 1, 1, 2, 2):
        held["add"](parts[number], number)
        state = found(event_time.current_windows(spark, path, kind), kind)
        if number == 1:
            held.setdefault("one", state)
            assert state == held["one"]
    held["add"](parts[2], 2)
    assert found(event_time.current_windows(spark, path, kind), kind) == state


def test_micros_of_zoneless_times(spark):
    at = datetime.datetime(2024, 3, 31, 2, 30, 7, 123456)
    early = datetime.datetime(1969, 12, 31, 23, 59, 59, 999999)
    table = spark.createDataFrame([(at,), (early,), (None,)], "ts timestamp_ntz")
    got = [r.m for r in table.select(windows.micros(F.col("ts")).alias("m")).collect()]
    epoch = datetime.datetime(1970, 1, 1)
    assert got == [(at - epoch) // datetime.timedelta(microseconds=1), -1, None]
