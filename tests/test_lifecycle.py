from __future__ import annotations

import random

from pricing_audit.operators import lifecycle
from pricing_audit.session import scratch_path
from pricing_audit.streaming import lifecycle as stream_of

SCHEMA = "contract_id string, status string, at long, seq long, kind string"


def plain(rows, limit, now=None):
    """Row by row: the log, and the states at its end."""
    log, since, status = [], {}, {}

    def expire(key, moment):
        if key in since and since[key] is not None:
            at, seq = since[key]
            if moment is None or at + limit < moment:
                log.append((key, at + limit, "OVERDUE", seq, "OVERDUE"))
                status[key], since[key] = "OVERDUE", None

    for key, state, at, seq, _ in sorted(
        (r for r in rows if r[2] is not None and (now is None or r[2] < now)),
        key=lambda r: (r[2], r[3], r[1] is not None, r[1] or ""),
    ):
        expire(key, at)
        if (state == "PENDING") == (key in since):
            log.append((key, at, state, seq, "REJECTED"))
            continue
        log.append((key, at, state, seq, "CHANGE"))
        status[key] = state
        if state == "PENDING":
            since[key] = (at, seq)
        else:
            del since[key]
    for key in list(since):
        expire(key, now)
    return sorted(log, key=str), status


def random_rows(rng, n, low, high):
    some = lambda x: None if rng.random() < 0.03 else x
    return [
        (some(rng.choice("abcdefgh")), some(rng.choice(["PENDING", "PENDING", "EXTRACTED", "FAILED"])),
         some(rng.randrange(low, high)), i + 1000 * high, "x") for i in range(n)
    ]


def found(df):
    return sorted((tuple(r[c] for c in ("contract_id", "at", "status", "seq", "kind")) for r in df.collect()), key=str)


def test_log_equals_row_by_row(spark):
    rows = random_rows(random.Random(1), 200, -50, 150)
    rows += [("z", "PENDING", 10, 1, "x"), ("z", "EXTRACTED", 15, 2, "x"), ("y", "PENDING", 10, 1, "x"), ("y", "FAILED", 16, 2, "x")]
    table = spark.createDataFrame(rows, SCHEMA)
    for now in (None, 100):
        log = lifecycle.lifecycle_log(table, 5, now)
        want, status = plain(rows, 5, now)
        assert found(log) == want
        assert {r.contract_id: r.status for r in lifecycle.latest_status(log).collect()} == status
    assert not [w for w in want if w[0] == "z" and w[4] == "OVERDUE"] and [w for w in want if w[0] == "y" and w[4] == "OVERDUE"]
    assert lifecycle.lifecycle_log(table.limit(0), 5).count() == 0


def test_stream_in_any_order_equals_the_batch(spark):
    rng, path, delay = random.Random(2), scratch_path(spark, "lifecycle"), 40
    accepted, late, mark = [], [], None
    for number in range(5):
        rows = random_rows(rng, 50, 60 * number - 60, 60 * number + 60) if number != 2 else []
        for r in rows:
            (late if r[2] is None or (mark is not None and r[2] < mark) else accepted).append(r)
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        stream_of.stream_lifecycle(arriving, f"{path}/out", f"{path}/checkpoint", 30, delay).awaitTermination()
        times = [r[2] - delay for r in rows if r[2] is not None]
        mark = max(times if mark is None else [mark, *times])
        assert found(stream_of.current_log(spark, f"{path}/out")) == plain(accepted, 30, mark)[0]
    assert late and spark.read.parquet(f"{path}/out/late").count() == len(late)
