"""Document folders: listing without reading the bytes, and reading the bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import customer_from_filename


def _binary_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def _name(path_column: str = "path"):
    return F.url_decode(F.element_at(F.split(path_column, "/"), -1)).alias("filename")


def list_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Directory listing, newest first. The content column is pruned, so no file is opened."""
    return (
        _binary_files(spark, path, glob)
        .select("path", _name(), F.col("length").alias("size"),
                F.col("modificationTime").alias("last_modified"))
        .orderBy(F.desc("last_modified"), "path")
    )


def read_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return _binary_files(spark, path, glob).select("path", _name(), "content")


def read_text_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Documents as (filename, text), decoded as UTF-8."""
    return read_documents(spark, path, glob).select(
        "filename", F.decode("content", "UTF-8").alias("text")
    )


def folder_documents(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """All documents of a folder as (filename, customer_id, content), the customer taken from the
    file name."""
    suffix = glob.lstrip("*")
    return read_documents(spark, path, glob).select(
        "filename", customer_from_filename(F.col("filename"), suffix).alias("customer_id"),
        "content",
    )
