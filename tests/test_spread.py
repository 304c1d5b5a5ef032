from __future__ import annotations

from pricing_audit.operators import semantic
from pricing_audit.plans import queries
from pricing_audit.sources import tables
from pyspark.sql import functions as F


def test_a_single_row_group_is_spread(spark, tmp_path):
    """A file of one row group has all its rows in one split, however many splits it is cut into."""
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        scan = spark.read.parquet(str(tmp_path / "t"))
        assert scan.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
        sizes = [r["count"] for r in tables.spread(scan, "doc_id").groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 4000 / 2 or spark.sparkContext.defaultParallelism == 1
        assert sum(sizes) == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rounds_read_counted_words(spark, monkeypatch):
    """What every round reads holds each word of a text once, with its count."""
    staged = []
    monkeypatch.setattr(semantic, "stage", lambda df, name: staged.append(df) or df)
    semantic.fit(spark.createDataFrame([(1, "a b a a"), (2, None), (3, "b c")], "doc_id long, text string"), rank=2)
    assert staged[0].columns == ["features", "counts"]
    assert sorted(sorted(r["counts"]) for r in staged[0].collect()) == [[], [1, 1], [1, 3]]


def test_runs_read_documents_spread_over_tasks(spark, tmp_path, monkeypatch):
    """Parts in one row group still give each task a share of the documents, also of repeated parts."""
    parts = spark.range(3000).selectExpr(
        "id % 2990 as p_partkey", "'name' as p_name", "'Brand#11' as p_brand", "'TIN' as p_type",
        "cast(id % 50 as int) as p_size", "cast(id as double) as p_retailprice")
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    given = []
    monkeypatch.setattr(queries.contracts, "extract_contracts", lambda spark, docs, *a, **k: given.append(docs))
    monkeypatch.setattr(queries, "_stored_lines", lambda *a: None)
    queries.QUERIES["two_contract_runs"](spark, str(tmp_path))
    sizes = [r["count"] for r in given[0].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2980 + 10 * 4
    assert max(sizes) < 3020 / 2 or spark.sparkContext.defaultParallelism == 1
