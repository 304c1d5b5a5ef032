"""Text quality by a generalised additive model with pairwise interactions.

A score is the sum of one number per feature and one per chosen pair of features, looked up by the
value's bin. The tables are learnt by cyclic boosting: round after round every feature in turn
gets a shallow tree over its bins, fitted to what the sum so far leaves unexplained, and a small
step of it is added to the feature's table; the strongest pairs follow on 2-dimensional tables.

The model is fitted on a bounded sample, ``TRAIN_ROWS`` labelled documents chosen by a hash of their
id; features and scores cover every whole text, one numpy pass over each batch, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread
from .common import binary_values, chunks_of_texts, ship_code, whole_text
from .shingles import words_of

TRAIN_ROWS = 20_000
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "lower", "digit", "mark", "symbol", "other",
    "space", "line_words", "repeated_lines", "shout_words", "end_marks", "distinct_words", "top_word",
)
_BLOCK = 1 << 18
_STRETCH = 200


def _classes() -> np.ndarray:
    kind = np.full(256, 6, np.uint8)  # other: bytes beyond ASCII and control characters
    for byte in range(128):
        c = chr(byte)
        if c.isupper():
            kind[byte] = 0
        elif c.islower():
            kind[byte] = 1
        elif c.isdigit():
            kind[byte] = 2
        elif c in ".,;:'\"()-?":
            kind[byte] = 3
        elif c in "\n":
            kind[byte] = 7
        elif c in " \t\r\x0b\f":
            kind[byte] = 5
        elif c.isprintable():
            kind[byte] = 4
    return kind


_KIND = _classes()


def features(texts: Iterable[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text, from its bytes; all finite, also for empty texts."""
    rows: list[tuple] = []
    for run in chunks_of_texts(texts, _BLOCK):
        for text, words in zip(run, words_of(run), strict=True):
            rows.append(_of_bytes(text) + _of_words(words))
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def _of_bytes(text: bytes) -> tuple:
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    if not n:
        return (0.0,) * (len(FEATURES) - 2)
    kind = _KIND[data]
    count = np.bincount(kind, minlength=8)
    edge = (kind[1:] == 5) | (kind[1:] == 7)  # a character before white space
    inner = kind[:-1]
    words = int(np.count_nonzero(edge & (inner != 5) & (inner != 7))) + int(kind[-1] not in (5, 7))
    ends = np.count_nonzero(edge & (inner == 4)) + int(kind[-1] == 4)
    shouts = np.count_nonzero((kind[:-1] == 0) & (kind[1:] == 0))
    lines = text.split(b"\n")
    return (
        np.log1p(n), np.log1p(words), min((n - count[5] - count[7]) / max(words, 1), 100.0),
        *(count[:5] / n), count[6] / n, (count[5] + count[7]) / n, min(words / len(lines), 1000.0),
        1 - len(set(lines)) / len(lines), shouts / n, ends / max(words, 1),
    )


def _of_words(words: np.ndarray) -> tuple[float, float]:
    if not len(words):
        return 0.0, 0.0
    ordered = np.sort(words)
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    runs = np.diff(np.append(first, len(words)))
    # Distinct words within stretches of equal length, so that long texts don't look repetitive.
    whole = len(words) // _STRETCH * _STRETCH
    parts = np.sort(words[:whole].reshape(-1, _STRETCH), axis=1)
    distinct = len(parts) + np.count_nonzero(parts[:, 1:] != parts[:, :-1])
    return (distinct + len(np.unique(words[whole:]))) / len(words), runs.max() / len(words)


@dataclass
class Model:
    """Cut points per feature, tables per feature and per pair, all added to ``base``."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], "right") for i, c in enumerate(self.cuts)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        bins = self.bins(x)
        for i, table in enumerate(self.tables):
            total += table[bins[:, i]]
        for (i, j), grid in zip(self.pairs, self.grids, strict=True):
            total += grid[self.coarse[i][bins[:, i]], self.coarse[j][bins[:, j]]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _leaf(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient / (weight + 1.0)


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """Values per bin of a tree with up to ``leaves`` runs of bins, grown by the best gain."""
    bounds = [(0, len(gradient))]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in bounds:
            if b - a < 2:
                continue
            g, w = np.cumsum(gradient[a:b]), np.cumsum(weight[a:b])
            left = g[:-1] ** 2 / (w[:-1] + 1)
            right = (g[-1] - g[:-1]) ** 2 / (w[-1] - w[:-1] + 1)
            gain = left + right - g[-1] ** 2 / (w[-1] + 1)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], (a, a + at + 1, b))
        if best[1] is None:
            break
        a, cut, b = best[1]
        bounds.remove((a, b))
        bounds += [(a, cut), (cut, b)]
    value = np.empty(len(gradient))
    for a, b in bounds:
        value[a:b] = _leaf(gradient[a:b].sum(), weight[a:b].sum())
    return value


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts each side of a grid once."""
    g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    w = np.pad(weight.cumsum(0).cumsum(1), ((1, 0), (1, 0)))

    def parts(t: np.ndarray) -> np.ndarray:
        a, top, left, whole = t[1:-1, 1:-1], t[1:-1, -1:], t[-1:, 1:-1], t[-1, -1]
        return np.stack(np.broadcast_arrays(a, top - a, left - a, whole - top - left + a))

    pg, pw = parts(g), parts(w)
    gain = (pg**2 / (pw + 1)).sum(0) - g[-1, -1] ** 2 / (w[-1, -1] + 1)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    values = _leaf(pg[:, i, j], pw[:, i, j])
    grid = np.empty_like(gradient)
    grid[: i + 1, : j + 1], grid[: i + 1, j + 1 :] = values[0], values[1]
    grid[i + 1 :, : j + 1], grid[i + 1 :, j + 1 :] = values[2], values[3]
    return float(gain[i, j]), grid


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 150, step: float = 0.15, bins: int = 32,
    leaves: int = 4, pairs: int = 8, pair_bins: int = 8,
) -> Model:
    """Train on features and 0/1 labels. Without rows the score is 1/2; with one class only, or
    constant features, it is the smoothed share of label 1."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    cuts = [np.unique(np.quantile(c, quantiles)) if len(y) else np.zeros(0) for c in x.T]
    model = Model(float(np.log(share / (1 - share))), cuts, [np.zeros(len(c) + 1) for c in cuts])
    if not 0 < y.sum() < len(y):
        return model
    where = model.bins(x)
    total = np.full(len(y), model.base)

    def left() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            if len(table) < 2:
                continue
            g, h = left()
            value = step * _tree(
                np.bincount(where[:, i], g, len(table)), np.bincount(where[:, i], h, len(table)), leaves
            )
            table += value
            total += value[where[:, i]]
    model.coarse = [np.arange(len(t)) * pair_bins // len(t) for t in model.tables]
    small = [model.coarse[i][where[:, i]] for i in range(x.shape[1])]

    def grid_of(i: int, j: int) -> tuple[float, np.ndarray]:
        g, h = left()
        cell = small[i] * pair_bins + small[j]
        shape = (pair_bins, pair_bins)
        return _quadrants(
            np.bincount(cell, g, pair_bins**2).reshape(shape), np.bincount(cell, h, pair_bins**2).reshape(shape)
        )

    ranked = sorted(
        ((grid_of(i, j)[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True
    )
    model.pairs = [(i, j) for gain, i, j in ranked[:pairs] if gain > 0]
    model.grids = [np.zeros((pair_bins, pair_bins)) for _ in model.pairs]
    for _ in range(rounds // 3):
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            value = step * grid_of(i, j)[1]
            grid += value
            total += value[small[i], small[j]]
    return model


def third(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled documents whose remainder is not 1; at most about ``TRAIN_ROWS`` of them.

    Of several labels of a document the more frequent one counts, 1 at a tie; null labels and ids
    are left out, and of repeated ids one text is taken.
    """
    ship_code(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("y"))
        .filter("id is not null and y is not null").filter(third(F.col("id")) != 1)
        .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )
    share = TRAIN_ROWS / max(known.count(), 1)
    if share < 1:
        known = known.filter(F.xxhash64("id") < int(share * 2**64) - 2**63)
    rows = docs.select("doc_id", whole_text().alias("text")).join(
        F.broadcast(known), F.col("doc_id") == F.col("id")
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(binary_values(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(found), pa.list_(pa.float64()))], ["id", "y", "x"]
            )

    measured = rows.select("id", "y", "text").mapInArrow(measure, "id long, y int, x array<double>")
    found = measured.groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x")).collect()
    found.sort(key=lambda r: r["id"])
    x = np.array([r["x"] for r in found], float).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r["y"] for r in found], float))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 from one half on).

    A null text is empty and is scored like any other; a null doc_id is never held out nor learnt
    from; repeated rows are scored each. Empty documents give no rows. Only doc_id and text are
    read of ``docs``, doc_id and quality of ``labels``.
    """
    model = train(docs, labels)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(features(binary_values(batch, "text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    held_out = F.coalesce(third(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    rows = spread(docs.select("doc_id", "text")).select("doc_id", held_out, whole_text().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not reject, with all their columns."""
    model = train(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(features(binary_values(batch, "text")))
            yield batch.filter(pa.array(score >= 0.5))

    return docs.mapInArrow(keep, docs.schema)
