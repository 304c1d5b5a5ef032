"""Documents that arrive again: a keyed state decides what has to be parsed.

The state holds, per file name and customer, when the newest text was modified and its hash. It lives
in RocksDB stores under the query's checkpoint. Documents share the state of a group, by a hash of their
keys, so Python is called once per group and batch, and not per document; a batch reads only its own
rows and the state of their groups, never the pages. Texts that differ from the newest known ones are
parsed and written with their batch's number; the pages of a document are those of its latest batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.pages import split_pages
from .jobs import _run, _write_batch

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ("filename", "customer_id")
GROUPS = 1 << 12


def _stamped(docs: DataFrame) -> DataFrame:
    """(filename, customer_id, modified, hash, text); without ``modified_at`` all rows are of one time.
    A null text has the empty hash."""
    modified = F.lit(0).cast("long")
    if "modified_at" in docs.columns:
        modified = F.coalesce(F.unix_micros(F.col("modified_at").cast("timestamp")), modified)
    text_hash = F.coalesce(F.sha2("text", 256), F.lit(""))
    return docs.select(*KEYS, modified.alias("modified"), text_hash.alias("hash"), "text")


def latest_documents(docs: DataFrame) -> DataFrame:
    """(filename, customer_id, text) of the row modified last, by hash where times are equal: what the
    stream has kept once all of ``docs`` has arrived, in any order."""
    newest = F.max_by("text", F.struct("modified", "hash")).alias("text")
    return _stamped(docs).groupBy(*KEYS).agg(newest)


def _newer(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The documents of a group whose newest text changed; the state is {keys: (modified, hash)}."""
    known = pickle.loads(state.get[0]) if state.exists else {}
    newest, texts = {}, {}
    for batch in batches:
        for row in zip(*(batch[c].tolist() for c in (*KEYS, "modified", "hash", "text")), strict=True):
            doc, version = row[:2], row[2:4]
            before = known.get(doc)
            best = newest.get(doc, before)
            if best is None or version > best:
                newest[doc] = version
                texts.pop(doc, None)
                if before is None or version[1] != before[1]:
                    texts[doc] = row[4]
    if newest:
        known.update(newest)
        state.update((pickle.dumps(known),))
    if texts:
        columns = [*zip(*texts, strict=True), list(texts.values())]
        yield pd.DataFrame(dict(zip((*KEYS, "text"), columns, strict=True)), dtype=object)


def stream_page_versions(
    docs: DataFrame, path: str, checkpoint: str, lines_per_page: int = 5,
    parsed_at: Column | None = None, available_now: bool = True, every: str = "1 minute",
    groups: int = GROUPS,
) -> StreamingQuery:
    """Arriving documents (filename, customer_id, text, modified_at if known) to the page cache under
    ``path``: new and changed ones are parsed, known ones are not, late older ones change nothing.

    ``groups`` bounds the calls of Python in a batch; a group with a new row rewrites its state, about
    100 bytes a document. It must stay the same for a checkpoint.
    """
    spark = docs.sparkSession
    group = F.pmod(F.xxhash64(*KEYS), F.lit(groups))
    changed = _stamped(docs).withColumn("group", group).groupBy("group").applyInPandasWithState(
        _newer, "filename string, customer_id string, text string", "known binary",
        "update", GroupStateTimeout.NoTimeout,
    )

    def ingest(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            _write_batch(split_pages(batch, lines_per_page, parsed_at), f"{path}/pages", batch_id)
            _write_batch(batch.select(*KEYS), f"{path}/documents", batch_id)
        finally:
            batch.unpersist()

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # read once, when the query starts
    try:
        # Without update mode Spark would ask for a watermark.
        writer = changed.writeStream.outputMode("update")
        return _run(changed, ingest, checkpoint, available_now, every, writer)
    finally:
        spark.conf.set(PROVIDER, before)


def current_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages of every document's latest text."""
    documents = spark.read.parquet(f"{path}/documents")
    latest = documents.groupBy(*[F.col(k).alias(f"__{k}") for k in KEYS]).agg(
        F.max("batch_id").alias("__batch")
    )
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEYS] + [F.col("batch_id") == F.col("__batch")]
    return spark.read.parquet(f"{path}/pages").join(latest, same, "left_semi").drop("batch_id")
