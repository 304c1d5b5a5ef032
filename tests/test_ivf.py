from __future__ import annotations

import numpy as np
from conftest import SF_DIR
from pricing_audit.operators import ivf, search
from pyspark import cloudpickle
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, list int, vector string"


def clustered(n, clusters, width, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, width))
    points = centers[rng.integers(0, clusters, n)] + 0.3 * rng.normal(size=(n, width))
    return [(i, p.astype(np.float32).tolist(), 1, "x") for i, p in enumerate(points)]


def queries_of(df):
    return df.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def test_clustered_vectors_need_few_lists(spark):
    df = spark.createDataFrame(clustered(4000, 60, 24), SCHEMA)
    index = ivf.build(df)
    assert len(index.centroids) == 63
    listed = index.vectors(spark)
    assert listed.count() == listed.select("vec_id").distinct().count() == 4000
    found = ivf.topk(spark, index, queries_of(df), 10)
    exact = search.vector_topk(df, queries_of(df), 10)
    row = ivf.recall(found, exact).first()
    assert row.exact_results == 2000 and row.reached
    assert index.probes(0.95) <= 63 // 3


def test_all_lists_give_the_exact_result(spark):
    df = spark.createDataFrame(clustered(500, 5, 8), SCHEMA)
    index = ivf.build(df, lists=9)
    found = ivf.topk(spark, index, queries_of(df), 7, probes=9, limit=2000)
    exact = search.vector_topk(df, queries_of(df), 7)
    order = ["query_id", "rank"]
    assert found.orderBy(order).collect() == exact.select(found.columns).orderBy(order).collect()


def test_tasks_hold_little_per_query_and_list(spark, monkeypatch):
    """What a task gets grows with the queries; of each query and list it is one bit."""
    monkeypatch.setattr(ivf, "SIMILARITIES_HELD", 1000, raising=False)
    df = spark.createDataFrame(clustered(2000, 5, 8), SCHEMA)
    index = ivf.build(df, lists=200)
    asked = df.select(F.col("vec_id").alias("query_id"), "embedding")
    sizes, ranked = [], ivf._ranked

    def watched(*args):
        sizes.append(len(cloudpickle.dumps(ranked(*args))))
        return ranked(*args)

    monkeypatch.setattr(ivf, "_ranked", watched)
    found = ivf.topk(spark, index, asked, 3, probes=200)
    assert sum(sizes) < 2000 * (8 + 8 * 8 + 200 / 8) + 50_000
    exact = search.vector_topk(df, asked, 3)
    order = ["query_id", "rank"]
    assert found.orderBy(order).collect() == exact.select(found.columns).orderBy(order).collect()


def test_only_probed_lists_are_read(spark):
    df = spark.createDataFrame(clustered(300, 5, 8), SCHEMA)
    index = ivf.build(df, lists=6)
    one = df.filter("vec_id = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    found = ivf.topk(spark, index, one, 500, probes=1)
    own = index.vectors(spark).filter("vec_id = 0").select("list")
    assert found.count() == index.vectors(spark).join(own, "list").count()
    assert "(list#" in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[0]


def test_odd_vectors_and_ties(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, []), (None, [0.0, 1.0]), (7, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, "") for i, v in rows], SCHEMA)
    index = ivf.build(df)
    asked = spark.createDataFrame([("a", [3.0, 0.0]), ("none", None), ("zero", [0.0, 0.0])], "query_id string, embedding array<double>")
    got = ivf.topk(spark, index, asked, 3, probes=99).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.similarity, r["rank"]) for r in got] == [("a", 1, 1.0, 1), ("a", 1, 1.0, 2), ("a", 2, 1.0, 3)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    index = ivf.build(empty)
    some = spark.createDataFrame(clustered(20, 2, 4), SCHEMA)
    assert ivf.topk(spark, index, queries_of(some), 3).count() == 0
    assert ivf.topk(spark, ivf.build(some), queries_of(empty), 3).count() == 0


def test_registered_table(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    assert ivf.build(df).vectors(spark).count() == df.count()
