"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import measured_bytes

WORD_SPACE = r"[\x20\x09-\x0D]+"
BROADCAST_LIMIT = 16 * 1024 * 1024


def ship_code(spark: SparkSession) -> None:
    """Send this package's modules to the executors, as --py-files would; once per application."""
    _ship(spark.sparkContext.applicationId, spark)


@cache
def _ship(application: str, spark: SparkSession) -> None:
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="code-"), "package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(target)


def whole_text(column: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def sized_join(
    left: DataFrame, right: DataFrame, on: list[Column], how: str, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Join that broadcasts the right side only if its measured payload fits ``limit`` bytes.

    Beyond the limit both sides are shuffled and adaptive execution splits skewed partitions.
    """
    small = measured_bytes(right) <= limit
    return left.join(F.broadcast(right) if small else right.hint("merge"), on, how)


def chunks_of_texts(texts: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """Runs of consecutive texts with about ``size`` bytes each; a longer text comes alone."""
    run: list[bytes] = []
    total = 0
    for text in texts:
        if run and total + len(text) > size:
            yield run
            run, total = [], 0
        run.append(text)
        total += len(text) + 1
    if run:
        yield run


def binary_values(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The column's values as bytes, one at a time and without decoding them; null becomes empty."""
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""
    pa.default_memory_pool().release_unused()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: nearby inputs get unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
