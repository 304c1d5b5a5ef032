"""Incremental versions of the batch jobs on Structured Streaming.

Each job handles a micro-batch with the batch operators and writes it to its own ``batch_id=N``
folder in overwrite mode: a batch replayed after a failure replaces its own earlier output, so the
result is exactly once without any state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.anomaly import alerts, billing_anomalies
from ..operators.joins import lookup_join
from ..operators.pages import split_pages, uncached
from ..operators.search import SearchIndex, build_index
from ..operators.segments import SegmentedIndex
from ..sources.tables import read_if_exists


def _run(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    available_now: bool, every: str, writer: DataStreamWriter | None = None,
) -> StreamingQuery:
    writer = (writer or stream.writeStream).foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=every
    )
    return writer.start()


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stream_pages(
    docs: DataFrame, cache_path: str, checkpoint: str, lines_per_page: int = 5,
    parsed_at: Column | None = None, available_now: bool = True, every: str = "1 minute",
) -> StreamingQuery:
    """Arriving documents (filename, customer_id, text) to the page cache, each file name once."""

    def ingest(batch: DataFrame, batch_id: int) -> None:
        cache = read_if_exists(batch.sparkSession, cache_path)
        fresh = batch.dropDuplicates(["filename"])
        if cache is not None:
            fresh = uncached(fresh, cache.filter(F.col("batch_id") != batch_id))
        _write_batch(split_pages(fresh, lines_per_page, parsed_at), cache_path, batch_id)

    return _run(docs, ingest, checkpoint, available_now, every)


def stream_anomalies(
    billing: DataFrame, rates: Callable[[SparkSession], DataFrame], path: str, checkpoint: str,
    alert_path: str | None = None, alert_threshold: float = 0.0,
    available_now: bool = True, every: str = "1 minute",
) -> StreamingQuery:
    """Arriving transactions joined to the rate card as it stands when the batch runs.

    Every batch checks the rate card's size again before broadcasting it. With ``alert_path``,
    transactions whose impact reaches the threshold are written there too.
    """

    def flag(batch: DataFrame, batch_id: int) -> None:
        flagged = billing_anomalies(batch, rates(batch.sparkSession))
        if alert_path is None:
            _write_batch(flagged, path, batch_id)
            return
        flagged = flagged.persist()
        try:
            _write_batch(flagged, path, batch_id)
            _write_batch(alerts(flagged, alert_threshold), alert_path, batch_id)
        finally:
            flagged.unpersist()

    return _run(billing, flag, checkpoint, available_now, every)


def stream_index(
    sections: DataFrame, path: str, checkpoint: str, attributes: tuple[str, ...] = (),
    available_now: bool = True, every: str = "1 hour",
) -> StreamingQuery:
    """Arriving sections (doc_id, text, attributes) to search postings.

    Texts are dealt out first: a batch may be a single file, even a single row group, and counting words
    costs far more than moving the text.
    """

    def index(batch: DataFrame, batch_id: int) -> None:
        cores = batch.sparkSession.sparkContext.defaultParallelism
        built = build_index(batch.repartition(cores), "text", attributes)
        _write_batch(built.docs, f"{path}/docs", batch_id)
        _write_batch(built.postings, f"{path}/postings", batch_id)

    return _run(sections, index, checkpoint, available_now, every)


def load_streamed_index(spark: SparkSession, path: str) -> SearchIndex:
    """Index written by ``stream_index``; a section sent again counts in its latest version."""
    docs = spark.read.parquet(f"{path}/docs")
    latest = docs.groupBy("doc_id").agg(F.max("batch_id").alias("batch_id"))


    def current(df: DataFrame) -> DataFrame:
        kept = lookup_join(df, latest, ["doc_id", "batch_id"], "left_semi")
        return kept.drop("batch_id")

    return SearchIndex(current(docs), current(spark.read.parquet(f"{path}/postings")))


def stream_segments(
    changes: DataFrame, path: str, checkpoint: str, attributes: tuple[str, ...] = (),
    order: str | None = None, available_now: bool = True, every: str = "1 hour",
) -> StreamingQuery:
    """Arriving changes (doc_id, text, attributes, removed) to a segmented index, which is never older
    than ``every``. A replayed batch is known by its number and changes nothing."""

    def add(batch: DataFrame, batch_id: int) -> None:
        SegmentedIndex(batch.sparkSession, path, attributes).apply(batch, batch_id, order=order)

    return _run(changes, add, checkpoint, available_now, every)
