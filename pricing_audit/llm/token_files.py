"""Token ids in binary files: frequency ranks in byte-aligned variable-length codes.

A file holds documents in ascending doc_id order as a run of blocks. Each block ranks its own ids by
frequency (ties by id), stores the ids in rank order, and codes every rank in one to four bytes; the
lengths stand apart, two bits each, four to a control byte, so a reader takes them from a table
of 256 entries and adds up whole arrays. The index at the end names the documents.

    file    "FRV1", blocks, index, index position (u64), "FRV1"
    block   tokens (u32), ranked ids (u32), data bytes (u32), ids (u32 each), control, data
    index   zlib of Arrow's stream: doc_id, n_tokens; and the blocks' positions in its metadata

Texts are tokenized where they lie and only compressed ids move, once, to the part of the doc_id
range that a file covers. The bounds of the ranges come from all ids' quantiles; ids that are
too frequent for one part (repeated or null) are dealt over several by a hash of the text.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import spread, stage
from .common import ship_code, whole_text
from .files import new_file, open_read, open_write
from .tokens import encoder

MAGIC = b"FRV1"
BLOCK_TOKENS = 1 << 20
BYTES_PER_FILE = 32 << 20
MOST_FILES = 20_000
DENSE_IDS = 1 << 22  # ids below are counted in a plain array
LAST = (1 << 63) - 1  # null ids come last
FILE_SCHEMA = "part int, path string, docs long, tokens long"

_CODES = np.arange(256, dtype=np.uint8)
#: Bytes of the four values that a control byte describes.
LENGTHS = np.stack([((_CODES >> (2 * i)) & 3) + 1 for i in range(4)], axis=1).astype(np.int64)


def encode_block(ids: np.ndarray) -> bytes:
    """One block; ``ids`` are unsigned integers below 2**32."""
    if ids.max() < DENSE_IDS:
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        which, counts = ids, counts[values]
        place = np.zeros(int(ids.max()) + 1, np.int64)
        place[values] = np.arange(len(values))
    else:
        values, which, counts = np.unique(ids, return_inverse=True, return_counts=True)
        place = np.arange(len(values))
    order = np.lexsort((values, -counts))
    rank = np.empty(len(values), np.uint32)
    rank[order] = np.arange(len(values), dtype=np.uint32)
    codes = rank[place][which]
    extra = (codes >= 1 << 8).astype(np.uint8) + (codes >= 1 << 16) + (codes >= 1 << 24)
    padded = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    padded[: len(codes)] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    bytes_of = codes.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = bytes_of[np.arange(4) <= extra[:, None]]
    head = struct.pack("<III", len(codes), len(values), len(data))
    return head + values[order].astype("<u4").tobytes() + control.tobytes() + data.tobytes()


def decode_block(block: bytes) -> np.ndarray:
    n, ranked, size = struct.unpack_from("<III", block)
    at = 12
    values = np.frombuffer(block, "<u4", ranked, at)
    at += 4 * ranked
    control = np.frombuffer(block, np.uint8, -(-n // 4), at)
    at += len(control)
    data = np.frombuffer(block, np.uint8, size, at)
    length = LENGTHS[control].reshape(-1)[:n]
    first = np.cumsum(length) - length
    codes = data[first].astype(np.uint32)
    for extra in (1, 2, 3):
        more = np.flatnonzero(length > extra)
        if not len(more):
            break
        codes[more] |= data[first[more] + extra].astype(np.uint32) << np.uint32(8 * extra)
    return values[codes]


class Writer:
    """Appends documents to one file, holding at most a block and a document in memory."""

    def __init__(self, path: str):
        self.path, self._out = path, open_write(path)
        self._out.write(MAGIC)
        self._at, self._blocks = len(MAGIC), []
        self._held: list[np.ndarray] = []
        self._size = 0
        self._names: list[int | None] = []
        self._counts: list[int] = []

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self._names.append(name)
        self._counts.append(len(ids))
        for at in range(0, len(ids), BLOCK_TOKENS):
            part = ids[at : at + BLOCK_TOKENS]
            self._held.append(part)
            self._size += len(part)
            if self._size >= BLOCK_TOKENS:
                self._flush()

    def _flush(self) -> None:
        if self._size:
            block = encode_block(np.concatenate(self._held))
            self._blocks.append([self._at, len(block), self._size])
            self._out.write(block)
            self._at += len(block)
            self._held, self._size = [], 0

    def close(self) -> tuple[str, int, int]:
        self._flush()
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_tokens", pa.int64())], {b"blocks": json.dumps(self._blocks).encode()}
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as stream:
            stream.write_batch(
                pa.record_batch(
                    [pa.array(self._names, pa.int64()), pa.array(self._counts, pa.int64())], schema=schema
                )
            )
        self._out.write(zlib.compress(sink.getvalue().to_pybytes(), 1))
        self._out.write(struct.pack("<Q", self._at) + MAGIC)
        self._out.close()
        return self.path, len(self._names), sum(self._counts)


def read_file(path: str) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
    """Each document's id and its ids in arrays of at most a block."""
    with open_read(path) as f:
        size = f.size()
        index_at, magic = struct.unpack("<Q4s", f.read_at(12, size - 12))
        if magic != MAGIC or f.read_at(4, 0) != MAGIC:
            raise ValueError(f"not a token file: {path}")
        index = zlib.decompress(f.read_at(size - 12 - index_at, index_at))
        table = pa.ipc.open_stream(index).read_all()
        blocks = iter(json.loads(table.schema.metadata[b"blocks"]))
        rest = np.zeros(0, np.uint32)

        def take(n: int) -> Iterator[np.ndarray]:
            nonlocal rest
            while n:
                if not len(rest):
                    at, length, _ = next(blocks)
                    rest = decode_block(f.read_at(length, at))
                part, rest = rest[:n], rest[n:]
                n -= len(part)
                yield part

        for name, n in zip(table["doc_id"].to_pylist(), table["n_tokens"].to_pylist(), strict=True):
            yield name, take(n)


def _bounds(docs: DataFrame) -> np.ndarray:
    """Upper doc_id bound of each file but the last; a bound may repeat for a very frequent id."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    size = docs.agg(F.sum(F.octet_length(whole_text()).cast("long") + 1)).first()[0] or 0
    least = docs.sparkSession.sparkContext.defaultParallelism
    files = min(max(-(-size // BYTES_PER_FILE), least), MOST_FILES)
    if files < 2:
        return np.zeros(0, np.int64)
    cuts = [i / files for i in range(1, files)]
    found = docs.agg(F.percentile_approx(key, cuts, 20 * files)).first()[0]
    return np.array(found or [], np.int64)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write all documents' ids to files below ``folder``; one row per file, in file order by part."""
    ship_code(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    bounds = _bounds(docs)
    parts = len(bounds) + 1

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pack = encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            key = batch.column(0).fill_null(LAST).to_numpy()
            low, high = np.searchsorted(bounds, key, "left"), np.searchsorted(bounds, key, "right")
            salt = batch.column(2).to_numpy().view(np.uint64)
            part = low + (salt % (high - low + 1).astype(np.uint64)).astype(np.int64)
            ids = [pack.compress(x.tobytes()) for x in encode.ids(batch.column(1))]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(part.astype(np.int32)), "doc_id": batch.column(0),
                    "key": pa.array(key), "ids": pa.array(ids, pa.binary()),
                }
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, unpack = encoder(tokenizer), zstandard.ZstdDecompressor()
        end = np.array([end_id], "<u4")
        writer, part = None, 0
        for batch in batches:
            for at, name, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if writer is None:
                    part = at
                    writer = Writer(new_file(folder, f"part-{at:06d}", ".frv"))
                plain = np.frombuffer(unpack.decompress(ids), encode.dtype)
                writer.add(name, np.concatenate((plain.astype("<u4"), end)))
        if writer is not None:
            path, n, tokens = writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": path, "docs": n, "tokens": tokens}],
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]),
            )

    texts = spread(docs).select("doc_id", whole_text().alias("text"), F.xxhash64("text").alias("salt"))
    dealt = texts.mapInArrow(tokenize, "part int, doc_id long, key long, ids binary")
    ordered = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("key", "ids")
    return stage(ordered.mapInArrow(write, FILE_SCHEMA), "token-files")


def read_tokens(files: DataFrame) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, from the files that ``files`` lists.

    The list has one row per file (at most ``MOST_FILES``), so the starts are added up here.
    """
    spark = files.sparkSession
    listed = sorted((r["part"], r["path"], r["tokens"]) for r in files.collect())
    starts = np.cumsum([0, *(t for _, _, t in listed)]).tolist()
    rows = [(i, path, start) for i, ((_, path, _), start) in enumerate(zip(listed, starts, strict=False))]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out: list[tuple] = []
                for name, arrays in read_file(path):
                    n = crc = 0
                    for ids in arrays:
                        crc, n = zlib.crc32(ids.astype("<u4", copy=False).tobytes(), crc), n + len(ids)
                    out.append((name, start, n, crc))
                    start += n
                columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(4)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(len(rows), 1)
    table = spark.createDataFrame(rows, "nth int, path string, start long")
    return table.repartitionById(tasks, F.col("nth")).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_table(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1) -> DataFrame:
    """Write ``docs`` to a new folder below the shared one and read the files back.

    A null text is empty and has the end id alone; documents with a null id come last; repeated ids
    stand side by side. Empty input writes no file and gives no rows. Other columns are not read.
    """
    folder = scratch_path(docs.sparkSession, "token-data")
    return read_tokens(write_tokens(docs, folder, tokenizer, end_id))
