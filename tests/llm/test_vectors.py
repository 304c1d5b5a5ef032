from __future__ import annotations

import numpy as np
import pytest
from pricing_audit.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cosine):
    good = [
        (i, np.array(v, float)) for i, v in rows
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = {i: set() for i, _ in rows}
    for a, x in good:
        for b, y in good:
            if a != b and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                links[a].add(b)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


@pytest.mark.parametrize("block", [16, 2048])
def test_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "LEAF", 8)
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(12, 10))
    rows = [(i, (centers[i % 12] + rng.normal(size=10) * rng.choice([0.05, 0.3])).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(40)]  # copies
    rows += [(500, None), (501, []), (502, [0.0] * 10), (503, [float("nan")] * 10), (504, [1.0, float("inf")] * 5),
             (505, [None] + [1.0] * 9), (506, [1.0, 2.0]), (507, [2.0, 4.0]), (508, [1e-30] * 10), (509, [1e30] * 10)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    got = vectors.near_duplicates(table, 0.9).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == plain(rows, 0.9)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_repeated_and_null_ids(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 1), (None, [1.0, 0.01], 0), (None, None, 0)], SCHEMA)
    got = sorted((tuple(r) for r in vectors.near_duplicates(table).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=str)
    assert vectors.near_duplicates(table.limit(0)).count() == 0


def test_distant_runs_are_skipped():
    x = np.eye(4)[np.repeat([0, 1], 600)]
    found = list(vectors.join_blocks(x, x, x, x, 0.9, True))
    assert sum(len(i) for i, _ in found) == 2 * 600 * 599 // 2


def test_vectors_are_not_dealt_per_pair_of_blocks(spark, monkeypatch):
    """What meets in a tile is read from files: only block numbers are shuffled for it."""
    monkeypatch.setattr(vectors, "BLOCK", 16)
    plans, plain_stage = {}, vectors.stage

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return plain_stage(df, name)

    monkeypatch.setattr(vectors, "stage", recorded)
    rng = np.random.default_rng(5)
    rows = [(i, (1 + 0.01 * rng.normal(size=6)).tolist(), 0) for i in range(200)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA), 0.9).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(199, 0)}
    assert "rows#" not in plans["links"]


def test_points_of_a_tile_hang_together_by_few_edges():
    forest = vectors.Forest(60)
    i, j = np.nonzero(np.equal.outer(np.arange(60) % 3, np.arange(60) % 3))
    edges = [e for e in forest.join(i, j)]
    assert sum(len(a) for a, _ in edges) == 57
    assert forest.parent.tolist() == [n % 3 for n in range(60)]
