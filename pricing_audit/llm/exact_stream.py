"""Exact duplicates by stateful streaming: a keyed state on disk that never expires.

Every text, with runs of white space replaced by one space, is reduced to its SHA-256. A stream reads
the fingerprints and keeps, per digest, the group's size, its smallest stable identifier and the
locator of that row's content (file and row in the file). The state lives in RocksDB stores that are
checkpointed to the shared folder, so memory does not grow with the number of texts and a lost
executor reloads its part. A hit counts only after the full bytes of both texts were compared.

All of it is DataFrame code: the stream pre-aggregates before its shuffle, so a digest that a third
of all rows share costs one row per task, and the byte check deals a large group over many tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.tables import stage
from .common import WORD_SPACE, sized_join, whole_text

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FINGERPRINT = "doc_id long, digest binary, file string, row long"
GROUPS = (
    "digest binary, size long,"
    " keep struct<no_id: boolean, doc_id: bigint, file: string, row: bigint>"
)
ROWS_PER_CHECK = 64  # members of one group that one copy of the kept text is compared with


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(whole_text(column), WORD_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with the locator columns __file and __row; rows that do not come from files are
    written to the shared folder first."""
    locator = [
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")
    ]
    try:
        return docs.select("*", *locator)
    except AnalysisException:
        return stage(docs, "documents").select("*", *locator)


def _first(*, alias: str) -> Column:
    """The row that stays: smallest doc_id, null ids last, then the first locator."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    return F.min(order).alias(alias)


def update_state(spark: SparkSession, fingerprints: str, state: str, per_batch: int = 0) -> None:
    """Run the stream over all fingerprint files that ``state`` has not seen yet, then stop.

    ``per_batch`` limits the files of one micro-batch (0: all that wait). A micro-batch writes the
    groups it changed to a folder of its own in overwrite mode, so a replay replaces itself.
    """
    own = spark.newSession()  # the settings below are this stream's alone
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Many small stores: no log space reserved ahead.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    reader = own.readStream.schema(FINGERPRINT)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    groups = (
        reader.parquet(fingerprints)
        .groupBy("digest").agg(F.count("*").alias("size"), _first(alias="keep"))
    )
    query = (
        groups.writeStream.outputMode("update")
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(
            lambda batch, n: batch.write.mode("overwrite").parquet(f"{state}/groups/batch={n}")
        )
        .start()
    )
    query.awaitTermination()


def latest_groups(spark: SparkSession, state: str) -> DataFrame:
    """Each digest's group as the last micro-batch that touched it left it."""
    schema = T._parse_datatype_string(GROUPS).add("batch", "long")
    rows = spark.read.schema(schema).parquet(f"{state}/groups")
    newest = F.max_by(F.struct("size", "keep"), "batch").alias("x")
    return rows.groupBy("digest").agg(newest).select("digest", "x.size", "x.keep")


def _decide(docs: DataFrame, digest, per_batch: int) -> DataFrame:
    """(doc_id, digest, file, row, size, keep) for every row of ``docs`` with locators."""
    spark = docs.sparkSession
    state = scratch_path(spark, "dedup-state")
    rows = docs.select(
        F.col("doc_id").cast("long"), digest(normalised()).alias("digest"),
        F.col("__file").alias("file"), F.col("__row").alias("row"),
    )
    rows.write.parquet(f"{state}/fingerprints")
    spark.createDataFrame([], GROUPS).write.parquet(f"{state}/groups/batch=-1")
    update_state(spark, f"{state}/fingerprints", state, per_batch)
    prints = spark.read.schema(FINGERPRINT).parquet(f"{state}/fingerprints")
    decided = stage(prints.join(latest_groups(spark, state), "digest"), "decisions")

    # Full bytes of every hit against the text that stays.
    members = decided.filter("size > 1").select(
        F.col("file").alias("__at"), F.col("row").alias("__nth"), F.col("digest").alias("__digest"),
        F.col("size").alias("__size"),
        F.expr("file = keep.file and row = keep.row").alias("__keeps"),
    )
    content = stage(
        sized_join(
            docs.select("doc_id", "text", "__file", "__row"), members,
            [F.col("__file") == F.col("__at"), F.col("__row") == F.col("__nth")], "inner",
        ).select(
            F.col("doc_id").cast("long"), F.col("__file").alias("file"),
            F.col("__row").alias("row"), F.col("__digest").alias("digest"),
            F.col("__keeps").alias("keeps"), normalised().alias("text"),
            F.ceil(F.col("__size") / ROWS_PER_CHECK).cast("int").alias("salts"),
        ),
        "hits",
    )
    kept = content.filter("keeps").select(
        "digest", F.col("text").alias("kept_text"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    hits = content.filter("not keeps").withColumn(
        "salt", F.pmod(F.xxhash64("file", "row"), F.col("salts")).cast("int")
    )
    odd = stage(
        hits.join(kept, ["digest", "salt"]).filter("text <> kept_text")
        .select("doc_id", "file", "row", "digest", "text"),
        "collisions",
    )
    if odd.isEmpty():
        return decided
    # Texts that only share a digest: these form groups by their full bytes.
    regrouped = odd.groupBy("digest", "text").agg(
        F.count("*").alias("own_size"), _first(alias="own_keep")
    )
    moved = odd.join(regrouped, ["digest", "text"]).select("file", "row", "own_size", "own_keep")
    fewer = odd.groupBy("digest").agg(F.count("*").alias("fewer"))
    return (
        decided.join(fewer, "digest", "left").join(moved, ["file", "row"], "left")
        .select(
            "doc_id", "digest", "file", "row",
            F.coalesce("own_size", F.col("size") - F.coalesce("fewer", F.lit(0))).alias("size"),
            F.coalesce("own_keep", "keep").alias("keep"),
        )
    )


def exact_duplicates(docs: DataFrame, digest=sha256, per_batch: int = 0) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    A null text is empty, so all null and empty texts are one group (a text of white space alone is
    one space, another group). The row with the smallest doc_id stays, null ids last; of repeated
    rows with equal ids exactly one stays. Empty input gives no rows. Other columns are not read.
    ``digest`` maps a text column to its state key; it may collide, results stay exact.
    """
    docs = located(docs)
    decided = _decide(docs, digest, per_batch)
    out = [
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        F.expr("file = keep.file and row = keep.row").alias("kept"),
    ]
    if digest is sha256:
        return decided.select(*out, F.lower(F.hex("digest")).alias("text_sha256"))
    hashes = docs.select(
        F.col("__file").alias("file"), F.col("__row").alias("row"),
        F.sha2(normalised(), 256).alias("text_sha256"),
    )
    return decided.join(hashes, ["file", "row"]).select(*out, "text_sha256")


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    rows = located(docs)
    dropped = stage(
        _decide(rows, sha256, 0).filter("not (file = keep.file and row = keep.row)")
        .select(F.col("file").alias("__at"), F.col("row").alias("__nth")),
        "dropped",
    )
    on = [F.col("__file") == F.col("__at"), F.col("__row") == F.col("__nth")]
    return sized_join(rows, dropped, on, "left_anti").drop("__file", "__row")
