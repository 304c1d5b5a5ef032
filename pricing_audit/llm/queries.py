"""The registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    conversations, exact_stream, jaccard, lm, mixing, packing, periodic, quality, rules,
    secrets, token_files, vectors, warc,
)
from .oracle import ORACLE as ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_table(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_files.token_table(docs, tokenizer="word_bpe_49k.json", end_id=1)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_stream.exact_duplicates(_table(spark, sf_dir, "documents"))


def op5_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=90)


def op7_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer="byte_bpe_50k.json", end_id=2, capacity=1024)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_table(_table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(_table(spark, sf_dir, "documents"))


def op12_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge_documents(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_table(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality": op2_quality,
    "op3_token_binary": op3_token_binary,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_embedding_neardup": op5_embedding_neardup,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_gru_scores": op7_gru_scores,
    "op8_mixing": op8_mixing,
    "op9_packing": op9_packing,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_line_rules": op12_line_rules,
    "op13_conversation_repair": op13_conversation_repair,
}
