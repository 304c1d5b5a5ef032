"""Near-duplicate vectors by an epsilon grid order join.

Vectors of cosine t or more, scaled to unit length, lie within e = sqrt(2 - 2t) of each other, and
so do their projections on any orthonormal directions. Vectors are sorted by their grid cells of
side e on the leading principal directions, and the sequence is cut into blocks. The join descends
from the whole sequence: intervals whose bounding boxes are further apart than e are skipped, the
others are split and joined part by part, first over blocks (as DataFrames, one level of a tree
a step) and then inside a pair of blocks. What remains is compared in double precision.

Blocks are written once to the shared folder; only their numbers are shuffled, and the task that
compares a tile of block pairs reads them from there. So what lies on disk grows with the vectors
although every block may have to meet every other.

Identical vectors are one point with a multiplicity. A tile returns each point's number of partners and
the edges of a spanning forest of its links, so the output of a dense tile grows with its points, not
with its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.tables import stage
from .common import ship_code
from .components import connected_components
from .files import new_file, open_read, open_write

BLOCK = 2048
PER_FILE = 8
# Blocks of one side that a task holds, and their bytes at most (one block at least).
TILE, TILE_BYTES = 16, 1 << 26
MOST_TASKS = 10_000
LEAF = 256
FAN_OUT = 8
AXES = 8
SLACK = 1e-6  # boxes are compared with this much room, exact products decide


def usable(vector: Column) -> Column:
    """True for vectors with a direction: not null or empty, finite, not all zero."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(
        (F.size(vector) > 0) & ~F.coalesce(wrong, F.lit(True)) & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def _digests(values: pa.Array, kind: str) -> list[bytes | None]:
    """A digest of each vector's bytes; None for null."""
    numbers = np.ascontiguousarray(values.flatten().to_numpy(zero_copy_only=False), kind)
    held, size = memoryview(numbers).cast("B"), numbers.itemsize
    ends = (np.cumsum(pc.fill_null(pc.list_value_length(values), 0).to_numpy()) * size).tolist()
    there, out, at = values.is_valid().to_pylist(), [], 0
    for end, good in zip(ends, there, strict=True):
        out.append(hashlib.blake2b(held[at:end], digest_size=32).digest() if good else None)
        at = end
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest entry first, so that squares stay finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal_directions(vectors: DataFrame, width: int) -> np.ndarray:
    """Leading eigenvectors of the second moments of the rows of column ``e`` (width x width sums from
    each task, added up on the executors)."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for part in _stacked(batch.column(0), width):
                total += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_buffer(), "<f8")
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    sums = vectors.select("e").mapInArrow(moments, "m binary").repartition(1).mapInArrow(add, "m binary")
    total = sum(np.frombuffer(r["m"], "<f8") for r in sums.collect())
    values, vectors = np.linalg.eigh(np.reshape(total, (width, width)))
    return vectors[:, np.argsort(-values)[:AXES]]


def _stacked(values: pa.Array, width: int, most: int = 4096) -> Iterator[np.ndarray]:
    """Unit rows of a batch of vectors of one width, a bounded number at a time."""
    rows = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    for at in range(0, len(rows), most):
        yield _unit(rows[at : at + most].astype(np.float64))


def _boxes_apart(low1, high1, low2, high2) -> np.ndarray:
    gap = np.maximum(np.maximum(low1 - high2, low2 - high1), 0)
    return np.sqrt((gap * gap).sum(axis=-1))


def join_blocks(
    x: np.ndarray, px: np.ndarray, y: np.ndarray, py: np.ndarray, cosine: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked index pairs between two runs of unit rows with projections; each pair once if ``same``.

    Recursive: runs whose boxes are too far apart are skipped, long ones are halved.
    """
    reach = np.sqrt(max(2 - 2 * cosine, 0)) + SLACK
    x32, y32 = x.astype(np.float32), y.astype(np.float32)
    least = np.float32(cosine - (x.shape[1] + 8) * 2.0**-23)
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if same and d <= a:
            continue  # the mirror image
        if _boxes_apart(px[a:b].min(0), px[a:b].max(0), py[c:d].min(0), py[c:d].max(0)) > reach:
            continue
        if b - a > LEAF or d - c > LEAF:
            left = [(a, (a + b) // 2), ((a + b) // 2, b)] if b - a > LEAF else [(a, b)]
            right = [(c, (c + d) // 2), ((c + d) // 2, d)] if d - c > LEAF else [(c, d)]
            todo += [(p, q, r, s) for p, q in left for r, s in right]
            continue
        # Single precision is off by less than ``least`` allows for; what it lets pass is compared again.
        i, j = np.nonzero(x32[a:b] @ y32[c:d].T >= least)
        i, j = i + a, j + c
        if same:
            i, j = i[i < j], j[i < j]
        if 8 * len(i) > (b - a) * (d - c):
            linked = (x[a:b] @ y[c:d].T)[i - a, j - c] >= cosine
        else:
            linked = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
        i, j = i[linked], j[linked]
        if len(i):
            yield i, j


class Forest:
    """Which of n points hang together; ``parent`` always names each point's root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links the pairs; yields those of them that joined two trees."""
        while True:
            r, s = self.parent[i], self.parent[j]
            apart = r != s
            if not apart.any():
                return
            i, j, r, s = i[apart], j[apart], r[apart], s[apart]
            # Every root is hooked to one smaller root, so no circle arises.
            greater, once = np.unique(np.maximum(r, s), return_index=True)
            self.parent[greater] = np.minimum(r, s)[once]
            yield i[once], j[once]
            while (up := self.parent[self.parent]).tobytes() != self.parent.tobytes():
                self.parent = up


def near_duplicates(table: DataFrame, cosine: float = 0.9) -> DataFrame:
    """Per row: vec_id, n_links (other rows linked), component_id (smallest vec_id reached), kept.

    Null, empty, zero or non-finite vectors, and vectors of different widths, link with nothing.
    Rows with equal vectors link with each other, repeated ids included; null ids are kept, and the
    component of null ids alone has a null component_id (its rows are kept). Empty input gives no
    rows. Only vec_id and embedding are read; labels play no part.
    """
    ship_code(table.sparkSession)
    kind = table.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vectors = table.select("vec_id", F.col("embedding").cast("array<float>" if single else "array<double>").alias("e"))
    dtype = "<f4" if single else "<f8"
    id_type = table.schema["vec_id"].dataType.simpleString()

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.array(_digests(batch.column(1), dtype), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), names, batch.column(2)], ["vec_id", "h", "w"])

    e = F.when(usable(F.col("e")), F.col("e"))
    rows = stage(
        vectors.select("vec_id", e.alias("e")).withColumn("w", F.size("e"))
        .mapInArrow(name, f"vec_id {id_type}, h binary, w int"),
        "vectors",
    )
    sizes = rows.filter("h is not null").select("w", "h").distinct().groupBy("w").count().orderBy("w").collect()
    found = None
    for nth, (width, n) in enumerate(sizes):
        own = vectors.filter(usable(F.col("e")) & (F.size("e") == width))
        part = _links(own, width, n, cosine, nth, dtype)
        found = part if found is None else tuple(a.unionByName(b) for a, b in zip(found, part, strict=True))
    if found is None:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    points, counts, edges = found
    labels = connected_components(edges).withColumnsRenamed({"node": "id", "label": "top"})
    sums = counts.groupBy("id").agg(F.sum("n").alias("n"))
    known = (
        points.join(sums, "id", "left").join(labels, "id", "left")
        .select("h", "least_id", F.coalesce("top", "id").alias("top"), (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n"))
    )
    known = stage(known, "linked")
    smallest = known.groupBy("top").agg(F.min("least_id").alias("component"))
    # Where products round differently, equal vectors may lie in two cells, as two linked points.
    final = known.join(smallest, "top").groupBy(F.col("h").alias("point")).agg(
        F.max("n").alias("n"), F.min("component").alias("component")
    )
    joined = rows.select("vec_id", "h").join(final, F.col("h") == F.col("point"), "left")
    component = F.when(F.col("h").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _read_block(path: str, offset: int, count: int, width: int, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows and multiplicities of a block."""
    size = count * width * np.dtype(dtype).itemsize
    with open_read(path) as f:
        f.seek(offset)
        held = f.read(size + 8 * count)
    rows = np.frombuffer(held, dtype, count * width).reshape(count, width).astype(np.float64)
    return _unit(rows), np.frombuffer(held, "<i8", count, size)


def _links(
    vectors: DataFrame, width: int, n: int, cosine: float, number: int, dtype: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(h, id, many, least_id) of the different vectors, (id, n) partial partner counts, weighed by
    multiplicity, and (u, v) edges, for the ``n`` different vectors of one width; ``number`` is the width's."""
    spark = vectors.sparkSession
    reach = float(np.sqrt(max(2 - 2 * cosine, 0)))
    side = max(reach, 1e-3)
    axes = principal_directions(vectors, width)
    used = axes.shape[1]
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal vectors of a batch as one row, with its grid cell."""
        for batch in batches:
            if not batch.num_rows:
                continue
            names = pa.array(_digests(batch.column(1), dtype), pa.binary())
            seen = pa.table({"h": names, "vec_id": batch.column(0), "nth": pa.array(np.arange(len(names)))})
            seen = seen.group_by("h").aggregate([("vec_id", "min"), ("nth", "min"), ("nth", "count")])
            at = seen["nth_min"].to_numpy()
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)[at].astype(dtype)
            cell = np.floor(_unit(flat.astype(np.float64)) @ axes / side).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "h": seen["h"].combine_chunks(), "many": seen["nth_count"].combine_chunks(),
                "least_id": seen["vec_id_min"].combine_chunks(),
                "v": pa.array([row.tobytes() for row in flat], pa.binary()),
                "cell": pa.array(list(cell), pa.list_(pa.int32())),
            })

    packed = vectors.mapInArrow(pack, f"h binary, many long, least_id {id_type}, v binary, cell array<int>")
    order = [F.col("cell")[i] for i in range(used)] + [F.col("h")]
    size = BLOCK
    folder = scratch_path(spark, "blocks")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Writes a partition's blocks to a file; returns the points, and a row with ``path`` per block."""
        partition = TaskContext.get().partitionId()
        path = new_file(folder, f"part-{partition}", ".bin")
        first, offset, held = (number << 56) + (partition << 33), 0, []

        def block(points: list[list]) -> pa.RecordBatch:
            nonlocal first, offset
            raw = b"".join(p[3] for p in points)
            many = np.array([p[1] for p in points], "<i8")
            out.write(raw)
            out.write(many.tobytes())
            p = _unit(np.frombuffer(raw, dtype).reshape(-1, width).astype(np.float64)) @ axes
            none = [None] * len(points)
            made = pa.RecordBatch.from_pydict(
                {
                    "h": [q[0] for q in points] + [points[0][0]],
                    "id": list(range(first, first + len(points))) + [first],
                    "many": many.tolist() + [len(points)],
                    "least_id": pa.array([q[2] for q in points] + [None], least_type),
                    "path": [*none, path], "offset": [*none, offset], "cell": [*none, points[0][4]],
                    "low": [*none, p.min(0).tolist()], "high": [*none, p.max(0).tolist()],
                },
                pa.schema([
                    ("h", pa.binary()), ("id", pa.int64()), ("many", pa.int64()), ("least_id", least_type),
                    ("path", pa.string()), ("offset", pa.int64()), ("cell", pa.list_(pa.int32())),
                    ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
                ]),
            )
            first += len(points)
            offset += len(raw) + 8 * len(points)
            return made

        with open_write(path) as out:
            for batch in batches:
                least_type = batch.schema.field("least_id").type
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if held and held[-1][0] == row[0]:
                        held[-1][1] += row[1]
                        held[-1][2] = min((x for x in (held[-1][2], row[2]) if x is not None), default=None)
                        continue
                    if len(held) == size:
                        yield block(held)
                        held = []
                    held.append(list(row))
            if held:
                yield block(held)

    # The cells in order, ties by content; a partition holds several blocks, and its last may be short.
    line = stage(
        packed.repartitionByRange(max(1, -(-n // (PER_FILE * BLOCK))), *order).sortWithinPartitions(*order).mapInArrow(
            cut,
            f"h binary, id long, many long, least_id {id_type}, path string, offset long, cell array<int>, "
            "low array<double>, high array<double>",
        ),
        "points",
    )
    # A row per block: small enough for one task and for the list that every task holds.
    blocks = stage(
        line.filter("path is not null").withColumn("block", F.row_number().over(Window.orderBy("cell", "h")) - 1)
        .select(F.col("block").cast("long"), "path", "offset", "id", F.col("many").alias("count"), "low", "high"),
        "blocks",
    )
    listed = {r[0]: tuple(r[1:]) for r in blocks.select("block", "path", "offset", "count", "id").collect()}
    shared = spark.sparkContext.broadcast(listed)
    pairs = stage(_near_pairs(blocks, len(listed), used, reach + SLACK), "block-pairs")
    points = line.filter("path is null").select("h", "id", "many", "least_id")
    # A tile is what one task compares: it holds ``across`` blocks and reads ``across`` others one by one.
    across = max(1, min(TILE, len(listed) // TILE, TILE_BYTES // (BLOCK * width * 8)))
    stretches = -(-len(listed) // across)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = shared.value

        def read(block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            path, offset, count, _ = where[block]
            x, many = _read_block(path, offset, count, width, dtype)
            return x, x @ axes, many

        for batch in batches:
            for near in batch.column(0).to_pylist():
                start, ids, total = {}, [], 0
                for block in sorted({p[s] for p in near for s in ("a", "b")}):
                    _, _, count, first = where[block]
                    start[block], total = total, total + count
                    ids.append(np.arange(first, first + count))
                ids = np.concatenate(ids)
                partners, forest, edges = np.zeros(total, np.int64), Forest(total), []
                kept = {}
                for b, some in groupby(sorted((p["b"], p["a"]) for p in near), key=lambda p: p[0]):
                    y, py, many_y = kept[b] if b in kept else read(b)
                    for _, a in some:
                        if a not in kept:
                            kept[a] = (y, py, many_y) if a == b else read(a)
                        x, px, many_x = kept[a]
                        for i, j in join_blocks(x, px, y, py, cosine, a == b):
                            np.add.at(partners, i + start[a], many_y[j])
                            np.add.at(partners, j + start[b], many_x[i])
                            edges.extend(forest.join(i + start[a], j + start[b]))
                hit = np.flatnonzero(partners)
                u = np.concatenate([ids[i] for i, _ in edges]) if edges else np.zeros(0, np.int64)
                v = np.concatenate([ids[j] for _, j in edges]) if edges else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.concat_arrays([pa.array(ids[hit]), pa.nulls(len(u), pa.int64())]),
                    "n": pa.concat_arrays([pa.array(partners[hit]), pa.nulls(len(u), pa.int64())]),
                    "u": pa.concat_arrays([pa.nulls(len(hit), pa.int64()), pa.array(u)]),
                    "v": pa.concat_arrays([pa.nulls(len(hit), pa.int64()), pa.array(v)]),
                })

    tile = [F.floor(F.col(x) / across).alias(f"tile_{x}") for x in ("a", "b")]
    tiles = pairs.groupBy(*tile).agg(F.collect_list(F.struct("a", "b")).alias("near")).select("near")
    # Small tiles are many a task, so that a task's start does not cost more than its work.
    most = MOST_TASKS if across == TILE else 4 * spark.sparkContext.defaultParallelism
    dealt = tiles.repartition(min(stretches * (stretches + 1) // 2, most))
    out = stage(dealt.mapInArrow(compare, "id long, n long, u long, v long"), "links")
    return points, out.filter("id is not null").select("id", "n"), out.filter("u is not null").select("u", "v")


def _near_pairs(blocks: DataFrame, count: int, axes: int, reach: float) -> DataFrame:
    """Pairs (a, b), a <= b, of the ``count`` blocks whose boxes are within reach: a descent through a
    tree of intervals with ``FAN_OUT`` children, so that distant stretches are dropped as wholes."""
    levels = 0
    while FAN_OUT**levels < count:
        levels += 1
    boxes = blocks.select("block", "low", "high")

    def level_boxes(level: int) -> DataFrame:
        node = F.floor(F.col("block") / FAN_OUT ** (levels - level)).cast("long")
        return boxes.groupBy(node.alias("node")).agg(
            F.array(*[F.min(F.col("low")[i]) for i in range(axes)]).alias("low"),
            F.array(*[F.max(F.col("high")[i]) for i in range(axes)]).alias("high"),
        )

    spark = blocks.sparkSession
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    children = F.sequence(F.lit(0), F.lit(FAN_OUT - 1))
    gap = " + ".join(
        f"pow(greatest(low1[{i}] - high2[{i}], low2[{i}] - high1[{i}], 0), 2)" for i in range(axes)
    )
    for level in range(1, levels + 1):
        box = level_boxes(level)
        split = (
            pairs.withColumn("x", F.explode(children)).withColumn("y", F.explode(children))
            .select((F.col("a") * FAN_OUT + F.col("x")).alias("a"), (F.col("b") * FAN_OUT + F.col("y")).alias("b"))
            .filter("a <= b")
        )
        pairs = (
            split.join(box.select(F.col("node").alias("a"), F.col("low").alias("low1"), F.col("high").alias("high1")), "a")
            .join(box.select(F.col("node").alias("b"), F.col("low").alias("low2"), F.col("high").alias("high2")), "b")
            .filter(f"sqrt({gap}) <= {reach!r}").select("a", "b")
        )
    return pairs
