"""Search by meaning: section vectors from a singular value decomposition of the tf-idf table.

Words are hashed to a fixed number of features, so what the driver and every task hold is bounded: the
idf of the features and one features x rank matrix. The decomposition is a randomised subspace
iteration: each round passes over the sparse rows once, every task adds up its rows' part of A'(A Q),
and the parts are added slice by slice on the executors. Rankings of words and of vectors are fused by
reciprocal ranks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import stage
from .search import SearchIndex, search, tokens, vector_topk

WIDTH, RANK, OVERSAMPLE = 1 << 14, 64, 16
MOST_ROUNDS, TOLERANCE = 20, 1e-5
SLICES = 32
_AT_ONCE = 1 << 18  # words counted at a time
_HELD = 1 << 21  # features multiplied at a time
# Fixed value: the usual constant of reciprocal rank fusion.
FUSION = 60


@dataclass(frozen=True)
class SemanticModel:
    """``idf`` per feature; ``basis``: features x rank, orthonormal columns by falling ``singular``."""

    idf: np.ndarray
    basis: np.ndarray
    singular: np.ndarray


def features(sections: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, features): the feature number of every word; a null text has none."""
    number = F.transform(tokens(text), lambda t: F.pmod(F.xxhash64(t), F.lit(width)).cast("int"))
    return sections.select("doc_id", F.coalesce(number, F.array().cast("array<int>")).alias("features"))


def _counted(lists: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The different words of a batch's texts, about _AT_ONCE words at a time: features, counts and the
    texts' bounds. A text without words is an empty row."""
    ends = np.cumsum(pc.list_value_length(lists).to_numpy()).astype(np.int64)
    words, at, done = lists.flatten().to_numpy(), 0, 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, done + _AT_ONCE, "right")))
        text = np.repeat(np.arange(to - at), np.diff(ends[at:to], prepend=done))
        one, count = np.unique(text * width + words[done : ends[to - 1]], return_counts=True)
        yield one % width, count, np.searchsorted(one, np.arange(to - at + 1) * width)
        at, done = to, ends[to - 1]


def counted(sections: DataFrame, text: str = "text", width: int = WIDTH, packed: bool = True) -> DataFrame:
    """(doc_id, features, counts) for every row: the different features of a text in order and how often it
    has them; packed as plain numbers in bytes, which pass through Spark as they are, or as lists."""
    kind, held = sections.schema["doc_id"].dataType.simpleString(), "binary" if packed else "array<int>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for found, times, bounds in _counted(batch.column(1), width):
                size = len(bounds) - 1
                if packed:
                    lists = [_packed(found, bounds, _kind(width)), _packed(times, bounds, np.int32)]
                else:
                    ends = pa.array(bounds.astype(np.int32))
                    lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (found, times)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, size), *lists], ["doc_id", "features", "counts"]
                )
                at += size

    return features(sections, text, width).mapInArrow(count, f"doc_id {kind}, features {held}, counts {held}")


def _kind(width: int) -> type:
    return np.uint16 if width <= 1 << 16 else np.int32


def _packed(values: np.ndarray, bounds: np.ndarray, kind: type) -> pa.Array:
    data = values.astype(kind)
    ends = (bounds * data.itemsize).astype(np.int64)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).cast(pa.binary())


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a column, packed or in lists, and the rows' bounds."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(), np.cumsum(np.r_[0, pc.list_value_length(column).to_numpy()])
    size = np.dtype(kind).itemsize
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if ends[0] == ends[-1]:
        return np.zeros(0, kind), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind), (ends - ends[0]) // size


@dataclass(frozen=True)
class _Block:
    """Unit tf-idf rows: features and weights of all rows, one after another, and the rows' bounds."""

    found: np.ndarray
    weight: np.ndarray
    bounds: np.ndarray


def _blocks(features: pa.Array, counts: pa.Array, idf: np.ndarray) -> Iterator[_Block]:
    """Some rows at a time, about _HELD features."""
    found, bounds = _unpacked(features, _kind(len(idf)))
    count, _ = _unpacked(counts, np.int32)
    at = 0
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + _HELD, "right")) - 1)
        own, ends = slice(bounds[at], bounds[to]), bounds[at : to + 1] - bounds[at]
        weight = (1 + np.log(count[own])) * idf[found[own]]
        row = np.repeat(np.arange(to - at), np.diff(ends))
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=to - at))
        yield _Block(found[own], weight / norm[row], ends)
        at = to


def _sums(at: np.ndarray, weight: np.ndarray, bounds: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For every stretch of ``at`` the weighted sum of the rows of ``right`` that it names."""
    out = np.zeros((len(bounds) - 1, right.shape[1]))
    held = np.empty((int(np.diff(bounds).max(initial=0)), right.shape[1]))
    ends = bounds.tolist()
    for i, (first, end) in enumerate(zip(ends, ends[1:])):  # noqa: B905
        if end > first:
            own = held[: end - first]
            np.take(right, at[first:end], axis=0, out=own, mode="clip")
            np.dot(weight[first:end], own, out=out[i])
    return out


def _add_gram(block: _Block, right: np.ndarray, total: np.ndarray) -> None:
    """Adds A'(A right) for the rows A: row by row, then feature by feature."""
    image = _sums(block.found, block.weight, block.bounds, right)
    order = np.argsort(block.found, kind="stable")
    row = np.repeat(np.arange(len(image)), np.diff(block.bounds))[order]
    sizes = np.bincount(block.found, minlength=len(total))
    used = np.flatnonzero(sizes)
    total[used] += _sums(row, block.weight[order], np.r_[0, np.cumsum(sizes[used])], image)


def _on_cores(rows: DataFrame, *columns: str) -> DataFrame:
    """As many parts as cores, however many files there are."""
    return rows.select(*columns).coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def _rows_with(rows: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """How many rows there are, and how many have each feature."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(width, np.int64)
        for batch in batches:
            n += batch.num_rows
            seen += np.bincount(_unpacked(batch.column(0), _kind(width))[0], minlength=width)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "seen": pa.array([seen.tobytes()], pa.binary())})

    found = _on_cores(rows, "features").mapInArrow(part, "n long, seen binary").collect()  # a row a core at most
    return sum(r["n"] for r in found), sum((np.frombuffer(r["seen"], np.int64) for r in found), np.zeros(width, np.int64))


def _gram_times(rows: DataFrame, idf: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """A'(A matrix) for the tf-idf rows A of (features, counts): one pass, parts added on the executors."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((idf, matrix))
    shape = matrix.shape

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, right = shared.value
        right, total = np.ascontiguousarray(right), np.zeros(shape)
        for batch in batches:
            for block in _blocks(*batch.columns, weights):
                _add_gram(block, right, total)
        if total.any():
            slices = [s.tobytes() for s in np.array_split(total, SLICES)]
            yield pa.RecordBatch.from_pydict(
                {"slice": pa.array(range(SLICES), pa.int32()), "sums": pa.array(slices, pa.binary())}
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = np.frombuffer(held)
                sums[at] = sums[at] + values if at in sums else values
        yield pa.RecordBatch.from_pydict(
            {
                "slice": pa.array(list(sums), pa.int32()),
                "sums": pa.array([v.tobytes() for v in sums.values()], pa.binary()),
            }
        )

    schema = "slice int, sums binary"
    parts = _on_cores(rows, "features", "counts").mapInArrow(part, schema)
    summed = parts.repartition(SLICES, "slice").mapInArrow(add, schema).collect()
    shared.unpersist()
    out = np.zeros(shape)
    for row in summed:
        np.array_split(out, SLICES)[row["slice"]][:] = np.frombuffer(row["sums"]).reshape(-1, shape[1])
    return out


def fit(
    sections: DataFrame, text: str = "text", rank: int = RANK, width: int = WIDTH, seed: int = 0
) -> SemanticModel:
    """The leading right singular vectors of the sections' unit tf-idf rows.

    Rounds go on until the singular values stand still, MOST_ROUNDS at most. Fewer vectors than
    ``rank`` come back where the table has no more; without words there are none.
    """
    rows = counted(sections, text, width, packed=False).select("features", "counts")
    return fit_counted(stage(rows, "features"), rank, width, seed)


def fit_counted(rows: DataFrame, rank: int = RANK, width: int = WIDTH, seed: int = 0) -> SemanticModel:
    """``fit`` on sections that are counted and written once, since every round reads them."""
    n, counts = _rows_with(rows, width)
    idf = np.log((1 + n) / (1 + counts)) + 1
    size = min(rank + OVERSAMPLE, np.count_nonzero(counts), n)
    if not size:
        return SemanticModel(idf, np.zeros((width, 0)), np.zeros(0))
    basis = np.random.default_rng(seed).normal(size=(width, size))
    basis[counts == 0] = 0
    basis = np.linalg.qr(basis)[0]
    before = np.zeros(size)
    for _ in range(MOST_ROUNDS):
        image = _gram_times(rows, idf, basis)
        values, turn = np.linalg.eigh(basis.T @ image)
        values, turn = values[::-1], turn[:, ::-1]
        ritz = basis @ turn
        if np.all(np.abs(values - before)[:rank] <= TOLERANCE * np.maximum(values[:rank], 1e-12)):
            break
        before = values
        basis = np.linalg.qr(image)[0]
    values = np.sqrt(np.maximum(values, 0))
    use = int(np.count_nonzero(values[:rank] > 1e-9 * values[0]))
    return SemanticModel(idf, ritz[:, :use], values[:use])


def section_vectors(sections: DataFrame, model: SemanticModel, text: str = "text") -> DataFrame:
    """(doc_id, embedding) for every row: its tf-idf row in the model's directions. A text without
    words, null or empty, has the zero vector, which is similar to nothing."""
    return counted_vectors(counted(sections, text, len(model.idf)), model)


def counted_vectors(rows: DataFrame, model: SemanticModel) -> DataFrame:
    """``section_vectors`` of sections that are counted."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        basis = np.ascontiguousarray(m.basis)
        for batch in batches:
            made = [_sums(b.found, b.weight, b.bounds, basis) for b in _blocks(*batch.columns[1:], m.idf)]
            flat = np.concatenate(made) if made else np.zeros((0, basis.shape[1]))
            ends = np.arange(len(flat) + 1, dtype=np.int32) * basis.shape[1]
            vectors = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors], ["doc_id", "embedding"])

    return rows.mapInArrow(project, f"doc_id {kind}, embedding array<double>")


def fused(rankings: list[DataFrame], k: int) -> DataFrame:
    """(query_id, doc_id, score, rank): the sum of 1 / (FUSION + rank) over the rankings that hold the
    document, ties by id."""
    parts = [r.select("query_id", "doc_id", (1 / (FUSION + F.col("rank"))).alias("part")) for r in rankings]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    score = F.round(F.sum("part"), 12).alias("score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    # The rankings are partitioned alike, but adaptive execution may cut them differently.
    ranked = together.repartition("query_id").groupBy("query_id", "doc_id").agg(score)
    return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def semantic_topk(
    vectors: DataFrame, questions: DataFrame, model: SemanticModel, k: int, question: str = "text"
) -> DataFrame:
    """(query_id, doc_id, similarity, rank): the sections nearest to each question."""
    asked = section_vectors(
        questions.select(F.col("query_id").alias("doc_id"), F.col(question).alias("text")), model
    ).withColumnRenamed("doc_id", "query_id")
    return vector_topk(vectors, asked, k, vec_id="doc_id").withColumnRenamed("vec_id", "doc_id")


def hybrid_search(
    index: SearchIndex, vectors: DataFrame, questions: DataFrame, model: SemanticModel, k: int,
    depth: int = 50, question: str = "text",
) -> DataFrame:
    """The best ``depth`` by words and by meaning, fused, the first ``k`` kept."""
    by_words = search(index, questions, depth)
    return fused([by_words, semantic_topk(vectors, questions, model, depth, question)], k)
