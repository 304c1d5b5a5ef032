"""Approximate vector search by an inverted file, with exact ranking of what the probes find.

Centroids come from a bounded sample of the vectors; every vector is listed under its nearest one, in
a folder per list. A query looks into the lists of its nearest centroids only: the scan is pruned to
the probed folders, and the similarities are those of the exact search (``search.vector_topk``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .joins import BROADCAST_BYTES, measured_bytes
from .search import RANK_DIGITS, SHOWN_DIGITS

# Bounds of what the driver and every task hold: lists, and sampled vectors per list.
MOST_LISTS, SAMPLE_PER_LIST, FIT_ROUNDS = 4096, 64, 12
CALIBRATION_QUERIES, CALIBRATION_K = 256, 10
VECTORS_PER_FILE = 1_000_000
# Similarities that the driver or a task holds at a time.
SIMILARITIES_HELD = 2_000_000


def _unit(values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows of the usable vectors and which they are; null, zero and non-finite ones are not."""
    usable = np.array(
        [v is not None and len(v) > 0 and np.isfinite(np.asarray(v, np.float64)).all() for v in values], bool
    )
    if not usable.any():
        return np.zeros((0, 0)), usable
    matrix = np.stack([np.asarray(v, np.float64) for v in values[usable]])
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    usable[np.flatnonzero(usable)[norms == 0]] = False
    return matrix[norms > 0] / norms[norms > 0][:, None], usable


def _closest(unit: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The number of each row's nearest centroid."""
    closest = np.empty(len(unit), np.int64)
    step = max(1, SIMILARITIES_HELD // max(len(centroids), 1))
    for start in range(0, len(unit), step):
        closest[start:start + step] = (unit[start:start + step] @ centroids.T).argmax(axis=1)
    return closest


@dataclass(frozen=True)
class InvertedFile:
    """``centroids``: unit rows. ``path``: Parquet of vec_id, vector, partitioned by ``list``.
    ``depths``: sorted, the place of the list of each true neighbour, in the order in which the
    neighbour's query would probe, as seen within the sample."""

    path: str
    centroids: np.ndarray
    depths: np.ndarray

    def probes(self, target: float) -> int:
        """Lists to probe so that the target's share of the sample's neighbours was reached."""
        if not len(self.depths):
            return len(self.centroids)
        return int(self.depths[min(math.ceil(target * len(self.depths)), len(self.depths)) - 1]) + 1

    def vectors(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("vec_id long, vector array<double>, list int").parquet(self.path)


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Spherical k-means; the start is spread over the sample, empty lists keep their centroid."""
    centroids = sample[np.linspace(0, len(sample) - 1, lists).astype(int)].copy()
    for _ in range(rounds):
        nearest = _closest(sample, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.sqrt((sums * sums).sum(axis=1))
        centroids[norms > 0] = sums[norms > 0] / norms[norms > 0][:, None]
    return centroids


def neighbour_depths(sample: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Where probing meets the nearest neighbours of some of the sample, itself left out. In the whole
    table neighbours are nearer than in a sample, so they are met earlier rather than later."""
    asking = np.linspace(0, len(sample) - 1, min(CALIBRATION_QUERIES, len(sample))).astype(int)
    similar = sample[asking] @ sample.T
    similar[np.arange(len(asking)), asking] = -np.inf
    k = min(CALIBRATION_K, len(sample) - 1)
    nearest = np.argsort(-similar, axis=1, kind="stable")[:, :k]
    listed = _closest(sample, centroids)
    order = np.argsort(-(sample[asking] @ centroids.T), axis=1, kind="stable")
    place = np.argsort(order, axis=1, kind="stable")
    return np.sort(place[np.arange(len(asking))[:, None], listed[nearest]].ravel())


def build(
    vectors: DataFrame, lists: int | None = None, vec_id: str = "vec_id", vector: str = "embedding",
    path: str | None = None,
) -> InvertedFile:
    """List every vector. ``lists`` defaults to the square root of their number, MOST_LISTS at most.

    The centroids are fitted on SAMPLE_PER_LIST vectors a list, those with the smallest hashes of
    their ids; all other vectors only pass through. Null, zero and non-finite vectors are in no list.
    """
    spark = vectors.sparkSession
    source = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    path = path or scratch_path(spark, "inverted-file")
    n = source.count()
    lists = max(1, min(lists or math.isqrt(n), MOST_LISTS, n))
    some = source.filter("vector is not null").orderBy(F.xxhash64("vec_id"), "vec_id")
    sample, _ = _unit(some.limit(lists * SAMPLE_PER_LIST).select("vector").toPandas()["vector"])
    if not len(sample):
        centroids, depths = np.zeros((0, 0)), np.zeros(0, int)
    else:
        centroids = fit_centroids(sample, min(lists, len(sample)))
        depths = neighbour_depths(sample, centroids)
    shared = spark.sparkContext.broadcast(centroids)  # MOST_LISTS rows at most

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            unit, usable = _unit(batch["vector"])
            if len(unit):
                batch = batch[usable]
                yield batch.assign(list=_closest(unit, shared.value).astype(np.int32))

    # Only vectors move, dealt so that a crowded list becomes several files.
    listed = source.mapInPandas(assign, "vec_id long, vector array<double>, list int")
    listed.hint("rebalance", "list").write.option("maxRecordsPerFile", VECTORS_PER_FILE).partitionBy(
        "list"
    ).mode("overwrite").parquet(path)
    return InvertedFile(path, centroids, depths)


def _probed(index: InvertedFile, unit: np.ndarray, probes: int) -> np.ndarray:
    """A row of bits per list: the queries that probe it, each its nearest lists, ties by number."""
    bits = np.zeros((len(index.centroids), (len(unit) + 7) // 8), np.uint8)
    # Whole bytes of bits at a time.
    step = 8 * max(1, SIMILARITIES_HELD // (8 * len(index.centroids)))
    for start in range(0, len(unit), step):
        near = np.round(unit[start:start + step] @ index.centroids.T, RANK_DIGITS)
        order = np.argsort(-near, axis=1, kind="stable")[:, :probes]
        asks = np.zeros(near.shape, bool)
        np.put_along_axis(asks, order, True, axis=1)
        packed = np.packbits(asks.T, axis=1)
        bits[:, start // 8:start // 8 + packed.shape[1]] = packed
    return bits


def topk(
    spark: SparkSession, index: InvertedFile, queries: DataFrame, k: int, probes: int | None = None,
    target: float = 0.95, query_id: str = "query_id", vector: str = "embedding",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(query_id, vec_id, similarity, rank) of the k best among the lists that each query probes: as
    many as the index was calibrated for at the ``target`` recall, unless ``probes`` says.

    Queries go to the tasks in blocks of at most ``limit`` bytes; a block reads only the folders that
    its queries probe, and each task keeps k candidates a query.
    """
    queries = queries.select(F.col(query_id).alias("query_id"), F.col(vector).cast("array<double>").alias("query"))
    probes = probes or index.probes(target)
    blocks = max(1, math.ceil(measured_bytes(queries) / limit))
    kind = queries.schema["query_id"].dataType.simpleString()
    schema = f"query_id {kind}, vec_id long, similarity double"
    best = spark.createDataFrame([], schema)
    for block in range(blocks):
        # Bounded: the measured bytes are spread over the blocks by hash.
        rows = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toPandas()
        unit, usable = _unit(rows["query"])
        if not len(unit) or not len(index.centroids):
            continue
        probed = _probed(index, unit, probes)
        wanted = np.flatnonzero(probed.any(axis=1)).tolist()
        found = index.vectors(spark).filter(F.col("list").isin(wanted)).mapInPandas(
            _ranked(unit, rows["query_id"].to_numpy()[usable], probed, k), schema
        )
        best = best.unionByName(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.withColumn("similarity", F.round("similarity", SHOWN_DIGITS))


def _ranked(unit: np.ndarray, names: np.ndarray, probed: np.ndarray, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for one, part in batch.groupby("list"):
                asking = np.flatnonzero(np.unpackbits(probed[int(one)], count=len(unit)))
                vectors, usable = _unit(part["vector"])
                ids = part["vec_id"].to_numpy()[usable]
                step = max(1, SIMILARITIES_HELD // max(len(ids), 1))
                for start in range(0, len(asking), step):
                    some = asking[start:start + step]
                    similar = np.round(unit[some] @ vectors.T, RANK_DIGITS) + 0.0
                    for q, row in zip(some.tolist(), similar, strict=True):
                        scores, kept = held.get(q, (np.empty(0), np.empty(0, np.int64)))
                        row_ids = ids
                        if len(scores) >= k:
                            near = row >= scores[-1]
                            row, row_ids = row[near], ids[near]
                        if len(row):
                            scores, kept = np.concatenate((scores, row)), np.concatenate((kept, row_ids))
                            top = np.lexsort((kept, -scores))[:k]
                            held[q] = scores[top], kept[top]
        for q, (scores, kept) in held.items():
            yield pd.DataFrame({"query_id": names[q], "vec_id": kept, "similarity": scores})

    return run


def recall(found: DataFrame, exact: DataFrame, target: float = 0.9) -> DataFrame:
    """One row: how many results the exact search has, how many of them were found, and whether these
    are the target's share."""
    hits = found.select("query_id", "vec_id", F.lit(1).alias("hit"))
    return (
        exact.select("query_id", "vec_id").join(hits, ["query_id", "vec_id"], "left")
        .agg(F.count("*").alias("exact_results"), F.count("hit").alias("found_results"))
        .withColumn("reached", F.col("found_results") >= target * F.col("exact_results"))
    )
