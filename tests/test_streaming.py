from __future__ import annotations

from conftest import SF_DIR
from pyspark.sql import functions as F

from pricing_audit.operators import anomaly, pages, search
from pricing_audit.session import scratch_path
from pricing_audit.sources import sample, testdata
from pricing_audit.streaming import jobs


def bag(df):
    return sorted(map(str, df.collect()))


def test_pages_arrive_once(spark):
    root = scratch_path(spark, "test-stream")
    schema = "filename string, customer_id string, text string"
    docs = spark.createDataFrame(
        [("a", "x", "1\n2"), ("b", "x", "3"), ("a", "x", "1\n2")], schema)
    later = spark.createDataFrame([("b", "x", "changed"), ("c", "x", "4\n5\n6\n7\n8\n9")], schema)

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        jobs.stream_pages(stream, f"{root}/cache", f"{root}/checkpoint").awaitTermination()
        return spark.read.parquet(f"{root}/cache").drop("parsed_at", "batch_id")

    docs.coalesce(1).write.parquet(f"{root}/in")
    wanted = pages.split_pages(docs.dropDuplicates(["filename"])).drop("parsed_at")
    assert bag(run()) == bag(wanted)
    later.coalesce(1).write.mode("append").parquet(f"{root}/in")
    extra = pages.split_pages(later.filter("filename = 'c'")).drop("parsed_at")
    assert bag(run()) == bag(wanted.unionByName(extra))
    assert bag(run()) == bag(wanted.unionByName(extra))


def test_flags_and_alerts_equal_batch(spark):
    root = scratch_path(spark, "test-flags")
    billing = sample.transactions(spark)
    half = F.col("txn_id") <= "TXN-2025-016"
    rates_path = f"{root}/rates"
    sample.rates(spark).write.parquet(rates_path)

    def run():
        stream = spark.readStream.schema(billing.schema).parquet(f"{root}/in")
        jobs.stream_anomalies(
            stream, lambda s: s.read.parquet(rates_path), f"{root}/flags", f"{root}/checkpoint",
            alert_path=f"{root}/alerts", alert_threshold=250.0,
        ).awaitTermination()

    for part in (half, ~half):
        billing.filter(part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        run()
    batch = anomaly.billing_anomalies(billing, sample.rates(spark))
    assert bag(spark.read.parquet(f"{root}/flags").drop("batch_id")) == bag(batch)
    alerts = spark.read.parquet(f"{root}/alerts").drop("batch_id")
    assert bag(alerts) == bag(anomaly.alerts(batch, 250.0))


def test_replayed_batch_replaces_itself(spark):
    path = scratch_path(spark, "test-replay")
    rows = spark.range(5)
    for _ in range(2):
        jobs._write_batch(rows, path, 0)
    assert spark.read.parquet(path).count() == 5


def test_index_keeps_latest_version(spark):
    root = scratch_path(spark, "test-postings")
    schema = "doc_id long, text string"
    questions = spark.createDataFrame([(1, "storage fees")], "query_id int, text string")
    batches = [[(1, "storage"), (2, "fees fees")], [(1, "retrieval"), (3, "storage fees")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        jobs.stream_index(stream, f"{root}/index", f"{root}/checkpoint").awaitTermination()
    current = spark.createDataFrame([(1, "retrieval"), (2, "fees fees"), (3, "storage fees")], schema)
    want = search.search(search.build_index(current), questions, 5)
    index = jobs.load_streamed_index(spark, f"{root}/index")
    assert bag(search.search(index, questions, 5)) == bag(want)


def test_one_file_is_indexed_by_many_tasks(spark):
    root = scratch_path(spark, "test-spread")
    rows = spark.range(64).selectExpr("id AS doc_id", "concat('word', id) AS text")
    rows.coalesce(1).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
    jobs.stream_index(stream, f"{root}/index", f"{root}/checkpoint").awaitTermination()
    written = spark.read.parquet(f"{root}/index/postings")
    assert written.count() == 64
    assert len(written.inputFiles()) == spark.sparkContext.defaultParallelism


def test_table_streams_from_folder_or_file(spark):
    """A table may be one file or a folder of parts; both arrive completely."""
    root = scratch_path(spark, "test-parts")
    labels = testdata.table(spark, SF_DIR, "labels")
    labels.repartition(3).write.parquet(f"{root}/labels.parquet")
    for base in (root, SF_DIR):
        out = scratch_path(spark, "test-parts-out")
        query = (
            testdata.stream(spark, base, "labels").writeStream.format("parquet")
            .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
            .start(f"{out}/rows")
        )
        query.awaitTermination()
        assert bag(spark.read.parquet(f"{out}/rows")) == bag(labels)
