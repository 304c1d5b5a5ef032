"""Packing documents into fixed-length token sequences by sums of squares.

An open sequence is known by its residual gap. A document goes where the sum of the squared numbers
of open sequences per gap becomes smallest, so no gap size piles up and later documents find a fit.
Documents come in decreasing length, and a new sequence is opened only when nothing open has room:
among those choices the rule is the same, and it needs the fewest sequences.

Tokenizing happens once, where the texts lie; only (document, length) rows are dealt to the packing
tasks, about ``PIECES_PER_TASK`` each. A task holds its open sequences in one counter per gap.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread, stage
from .common import ship_code, whole_text
from .tokens import encoder

PIECES_PER_TASK = 100_000
_PIECE = [
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
]
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; only what is longer than ``capacity`` is cut, and then all
    pieces but the first are full."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False
) -> DataFrame:
    """A row per piece of each document's ids (end id included); ``with_ids`` adds them as bytes of
    little-endian unsigned 32-bit integers."""
    ship_code(docs.sparkSession)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows: list[tuple] = []
            held: list[bytes] = []
            names = batch.column(0).to_pylist()
            for name, found in zip(names, encode.ids(batch.column(1)), strict=True):
                ids = np.concatenate((found.astype("<u4"), end))
                for nth, (at, length) in enumerate(cut_points(len(ids), capacity)):
                    part = ids[at : at + length].tobytes()
                    rows.append((name, nth, at, length, zlib.crc32(part)))
                    if with_ids:
                        held.append(part)
            columns = [
                pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_PIECE)
            ]
            fields = [name for name, _ in _PIECE]
            if with_ids:
                columns, fields = [*columns, pa.array(held, pa.binary())], [*fields, "ids"]
            yield pa.RecordBatch.from_arrays(columns, fields)

    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return texts.mapInArrow(tokenize, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and offset of each length (all at most ``capacity``), in the order given."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by residual gap
    count = np.zeros(capacity + 1, np.int64)
    closing = np.ones(capacity + 1, np.int64)
    closing[0] = 0  # a full sequence no longer counts
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    sequences = 0
    for i, size in enumerate(lengths.tolist()):
        have = count[size:]
        change = np.where(
            have > 0, (2 * count[: len(have)] + 1) * closing[: len(have)] + 1 - 2 * have,
            np.iinfo(np.int64).max,
        )
        best = int(change.argmin())
        if have[best]:
            gap = size + best
            sequence = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, sequence = capacity, sequences
            sequences += 1
        where[i], offset[i] = sequence, capacity - gap
        left = gap - size
        if left:
            open_at[left].append(sequence)
            count[left] += 1
    return where, offset


def pack(rows: DataFrame, capacity: int) -> DataFrame:
    """``rows`` (with a ``length`` of 1 to ``capacity``) plus sequence_id and offset.

    The input is written to the shared folder once, so row numbers are stable. Full pieces are
    sequences of their own and skip the packing tasks.
    """
    ship_code(rows.sparkSession)
    held = stage(rows.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    whole = held.filter(F.col("length") == capacity).select(
        *rows.columns, (-F.col("__row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    partial = held.filter(F.col("length") < capacity)
    tasks = -(-partial.count() // PIECES_PER_TASK) or 1

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Only the row's number, its task and its length are here: 20 bytes a row.
        together = list(parts)
        if not together:
            return
        table = pd.concat(together)
        order = np.lexsort((table["__row"].to_numpy(), -table["length"].to_numpy()))
        table = table.iloc[order]
        where, offset = sum_of_squares(table["length"].to_numpy(), capacity)
        first = table["__task"].to_numpy().astype(np.int64) << 40
        yield pd.DataFrame({"__id": table["__row"].to_numpy(), "sequence_id": first + where, "offset": offset})

    dealt = partial.select("__row", "length", F.pmod(F.xxhash64("__row"), F.lit(tasks)).cast("int").alias("__task"))
    placed = dealt.repartitionById(tasks, F.col("__task")).mapInPandas(
        place, "__id long, sequence_id long, offset long"
    )
    packed = partial.join(placed, F.col("__row") == F.col("__id"))
    return whole.unionByName(packed.select(*rows.columns, "sequence_id", "offset"))


def pack_documents(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, capacity: int = 1024
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Rows are packed one by one, so repeated rows and null
    ids are packed as often as they occur. Empty input gives no rows; other columns are not read.
    """
    return pack(pieces(spread(docs.select("doc_id", "text")), tokenizer, end_id, capacity), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves, from packed pieces that carry ``ids``: sequence_id, ids
    (bytes, pieces in order of their offset) and the documents in it. A group is one sequence, so
    its size is bounded by the capacity."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("p")).select(
        "sequence_id",
        F.aggregate(F.col("p.ids"), F.lit(b""), lambda all_, ids: F.concat(all_, ids)).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"),
    )
