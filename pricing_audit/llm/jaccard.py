"""Near-duplicate groups of documents: an exact set-similarity join with grouped prefixes.

Two documents link when the Jaccard similarity of their distinct k-word shingles reaches a
threshold given as a whole percentage. Documents with the same shingle set form one class, classes
with the same size and prefix one group; groups meet through shared prefix shingles, pairs of groups
are filtered by size, position and a bitmap, and only the survivors are expanded to members and
verified. The bitmap has a bit for each hash bucket of shingles that holds an odd number of the set's
members; bits that differ between two sets each stand for a shingle that only one of them has, so
their count limits what the sets can share and never rejects a pair that links.

Links are looked for in two rounds, so that a large group of near copies does not produce all its
pairs. First every group meets one hub per shingle, which costs one pair per posting; the hub is the
set whose shingles are the most frequent on average, which among changed copies is the text they were
made from. Then only pairs whose ends are still in different components are built. No link between
different components can be lost: a pair that is skipped has both ends in one component already.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread, stage
from .common import binary_values, mix64, ship_code, sized_join, whole_text
from .components import connected_components
from .exact_stream import located
from .shingles import shingle_sets

# Shingles are ranked by how full their bucket is; the table's size does not depend on the data.
BUCKET_BITS = 22
SLICES = 64
BITMAP_WORDS = 16
WIDE_WORDS, WIDE_FROM = 64, 1000  # larger sets fill a small bitmap and have a wide one as well
PREFIX_SCHEMA = (
    "doc_id long, file string, row long, n int, c binary, g long, fill float, bits array<bigint>,"
    " wide array<bigint>, prefix array<bigint>"
)
SET_BYTES = 8 << 20  # of sets sent on at once
SET_SCHEMA = "c binary, members binary"


def _class_key(members: np.ndarray) -> bytes:
    """128 bits that depend on the set alone."""
    return np.array(
        [
            np.bitwise_xor.reduce(mix64(members + np.uint64(7))) + np.uint64(len(members)),
            np.sum(mix64(members ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64),
        ],
        dtype=">u8",
    ).tobytes()


def _bucket(members: np.ndarray) -> np.ndarray:
    return (members >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _bitmap(members: np.ndarray, words: int) -> np.ndarray:
    """64 * words parity bits of the set, as words."""
    odd = np.bincount((mix64(members) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def bucket_counts(docs: DataFrame, k: int) -> np.ndarray:
    """Documents per shingle bucket, over all documents. Tasks send fixed-size partial tables,
    which are added up slice by slice on the executors; one table of 2**22 counts comes back."""
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.int32)
        for batch in batches:
            for members in shingle_sets(binary_values(batch, "text"), k):
                np.add.at(table, _bucket(members), 1)
        parts = [zlib.compress(part.tobytes(), 1) for part in np.split(table, SLICES)]
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(range(SLICES), pa.int32()), "counts": pa.array(parts, pa.binary())}
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = np.frombuffer(zlib.decompress(counts), np.int32)
                sums.setdefault(part, np.zeros(size // SLICES, np.int64))
                sums[part] += values
        full = [np.minimum(v, np.iinfo(np.int32).max).astype(np.int32) for v in sums.values()]
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(list(sums), pa.int32()),
                "counts": pa.array([v.tobytes() for v in full], pa.binary()),
            }
        )

    schema = "part int, counts binary"
    partial = docs.select(whole_text().alias("text")).mapInArrow(count, schema)
    rows = partial.repartition(SLICES, "part").mapInArrow(add, schema).collect()
    by_part = {row["part"]: np.frombuffer(row["counts"], np.int32) for row in rows}
    empty = np.zeros(size // SLICES, np.int32)
    return np.concatenate([by_part.get(i, empty) for i in range(SLICES)])


def prefixes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per document: set size, class key, group hash (of size and prefix), fill, bitmap, and the
    shingles of its prefix, rarest first. Any fixed order of the shingles is right; this one keeps
    frequent passages out of prefixes. ``fill`` says how frequent the set's shingles are on average:
    a text that many others were changed from has more of it than any of them.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(bucket_counts(docs, k))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, groups, fills, heads, maps, wide = [], [], [], [], [], [], []
            for members in shingle_sets(binary_values(batch, "text"), k):
                n = len(members)
                length = n - (percent * n + 99) // 100 + 1 if n else 0
                filled = table.value[_bucket(members)]
                fills.append(float(np.log2(filled + 1.0).mean()) if n else 0.0)
                if n > 8 * length:  # only the smallest have to be put in order
                    edge = np.partition(filled, length - 1)[length - 1]
                    keep = np.flatnonzero(filled <= edge)
                    members_kept, filled = members[keep], filled[keep]
                else:
                    members_kept = members
                head = members_kept[np.lexsort((members_kept, filled))[:length]]
                sizes.append(n)
                classes.append(_class_key(members))
                place = np.arange(1, length + 1, dtype=np.uint64)
                mixed = np.sum(mix64(head + mix64(place)), dtype=np.uint64, keepdims=True)
                groups.append(int(mix64(mixed + np.uint64(n)).view(np.int64)[0]))
                maps.append(_bitmap(members, BITMAP_WORDS))
                wide.append(_bitmap(members, WIDE_WORDS) if n >= WIDE_FROM else None)
                heads.append(head.view(np.int64))
            at = np.cumsum([0, *map(len, heads)]).astype(np.int32)
            flat = np.concatenate(heads) if heads else np.zeros(0, np.int64)
            words = np.concatenate(maps) if maps else np.zeros(0, np.int64)
            each = np.arange(0, len(words) + 1, BITMAP_WORDS, dtype=np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0), "file": batch.column(1), "row": batch.column(2),
                    "n": pa.array(sizes, pa.int32()),
                    "c": pa.array(classes, pa.binary()),
                    "g": pa.array(groups, pa.int64()),
                    "fill": pa.array(fills, pa.float32()),
                    "bits": pa.ListArray.from_arrays(pa.array(each), pa.array(words)),
                    "wide": pa.array(wide, pa.list_(pa.int64())),
                    "prefix": pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
                }
            )

    here = [
        F.col(name) if name in docs.columns else F.lit(None).cast(kind).alias(name)
        for name, kind in (("__file", "string"), ("__row", "long"))
    ]
    rows = docs.select(F.col("doc_id").cast("long"), *here, whole_text().alias("text"))
    return rows.mapInArrow(cut, PREFIX_SCHEMA)


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The whole shingle sets of the classes in ``wanted`` (c, doc_id), read again from the texts."""
    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    rows = sized_join(
        docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")),
        ids, [F.col("doc_id").eqNullSafe(F.col("wanted_id"))], "left_semi",
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held, size = [], [], 0
            for members in shingle_sets(binary_values(batch, "text"), k):
                keys.append(_class_key(members))
                held.append(members.tobytes())
                size += len(held[-1])
                if size > SET_BYTES:
                    yield _set_rows(keys, held)
                    keys, held, size = [], [], 0
            yield _set_rows(keys, held)

    built = rows.mapInArrow(build, SET_SCHEMA)
    return built.join(wanted.select("c"), "c", "left_semi").dropDuplicates(["c"])


def _set_rows(keys: list[bytes], held: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"c": pa.array(keys, pa.binary()), "members": pa.array(held, pa.binary())}
    )


def verified(
    docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int
) -> DataFrame:
    """Those of the class pairs (a, b) that link, as (u, v): shared shingles are counted exactly."""
    pairs = stage(pairs, "pairs")
    used = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c")))
    wanted = stage(classes.join(used.distinct(), "c", "left_semi").select("c", "doc_id"), "wanted")
    sets = stage(_sets(docs, wanted, k), "sets")
    side_a = sets.select(F.col("c").alias("a"), F.col("members").alias("set_a"))
    side_b = sets.select(F.col("c").alias("b"), F.col("members").alias("set_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                x = np.frombuffer(one.as_buffer(), np.uint64)
                y = np.frombuffer(two.as_buffer(), np.uint64)
                both = np.sort(np.concatenate((x, y)))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["u", "v"])

    joined = pairs.join(side_a, "a").join(side_b, "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(check, "u binary, v binary")


def _sizes_fit(percent: int) -> str:
    return f"100 * least(n1, n2) >= {percent} * greatest(n1, n2)"


def _places_fit(percent: int) -> str:
    """What two sets can share when they first meet at the prefix places p1 and p2 is enough."""
    return f"(100 + {percent}) * least(n1 - p1, n2 - p2) >= {percent} * (n1 + n2)"


def _apart_fits(percent: int, apart: str) -> str:
    """Shingles that only one set has leave enough to share; true where a bitmap is missing."""
    return f"coalesce((100 + {percent}) * (n1 + n2 - ({apart})) >= {2 * percent} * (n1 + n2), true)"


def _small_fits(percent: int) -> str:
    small = " + ".join(f"bit_count(bits1[{i}] ^ bits2[{i}])" for i in range(BITMAP_WORDS))
    return _apart_fits(percent, small)


def _bitmaps_fit(percent: int) -> str:
    wide = "aggregate(zip_with(wide1, wide2, (x, y) -> bit_count(x ^ y)), 0, (a, x) -> a + x)"
    return f"{_small_fits(percent)} and {_apart_fits(percent, wide)}"


def open_pairs(listed: DataFrame, percent: int) -> DataFrame:
    """(g1, g2) of groups that meet in a posting list, are not wholly in one component and may link."""
    fields = [x for x in listed.columns if x != "s"]
    one, two = (listed.select("s", *[F.col(x).alias(f"{x}{i}") for x in fields]) for i in (1, 2))
    meet = (
        (F.col("g1") < F.col("g2")) & F.expr("not (lo1 = hi1 and lo1 = lo2 and lo2 = hi2)")
        & F.expr(_sizes_fit(percent)) & F.expr(_places_fit(percent)) & F.expr(_small_fits(percent))
    )
    return one.join(two, "s").filter(meet).select("g1", "g2")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles (long), component_id (smallest linked doc_id).

    A null text is empty; a document without words links with nothing and is its own component.
    Rows with the same shingles are linked whatever their ids, repeated rows and repeated ids
    included; a null doc_id is kept, and a component of null ids only has a null component_id. Empty
    input gives no rows. Only doc_id and text are read, so other columns may have any names.
    """
    return _decided(spread(docs.select("doc_id", "text")), k, percent).drop("file", "row", "label")


def _decided(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``near_duplicates`` with the rows' locators, where ``docs`` has them, and the component's label,
    null for documents without words."""
    ship_code(docs.sparkSession)
    cut = stage(prefixes(docs, k, percent), "prefixes")
    full = cut.filter("n > 0")
    classes = stage(
        full.groupBy("c").agg(
            F.first("g").alias("g"), F.first("n").alias("n"), F.first("bits").alias("bits"),
            F.first("wide").alias("wide"), F.min("doc_id").alias("doc_id"),
        ),
        "classes",
    )
    groups = full.groupBy("g").agg(F.first("prefix").alias("prefix"), F.max("fill").alias("fill"))
    postings = groups.select("g", "fill", F.posexplode("prefix").alias("p", "s"))
    hubs = (
        postings.groupBy("s")
        .agg(F.count("*").alias("lists"), F.max(F.struct("fill", "g"))["g"].alias("hub"))
        .filter("lists > 1").select("s", "hub")
    )
    shared = stage(postings.select("g", "p", "s").join(hubs, "s"), "postings")

    def ends(table: DataFrame, nth: int, *names: str) -> DataFrame:
        return table.select(*[F.col(x).alias(f"{x}{nth}") for x in names])

    def candidates(pairs: DataFrame) -> DataFrame:
        """Pairs of classes (a, b), once each, whose sizes and bitmaps fit."""
        return (
            pairs.filter(_sizes_fit(percent)).filter(_bitmaps_fit(percent))
            .select(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b")).distinct()
        )

    # Round 1: every group meets its hubs, every class the first class of its own group.
    about = ("c", "n", "bits", "wide")
    first = classes.groupBy("g").agg(F.min_by(F.struct(*about), "c").alias("x")).select(
        F.col("g").alias("hub"), *[F.col(f"x.{x}").alias(f"{x}1") for x in about]
    )
    member = ends(classes, 2, "g", *about)
    sizes = classes.groupBy("g").agg(F.first("n").alias("n"))
    met = (
        shared.filter("g <> hub").select("g", "hub").distinct()
        .join(sizes.withColumnRenamed("n", "n2"), "g")
        .join(sizes.select(F.col("g").alias("hub"), F.col("n").alias("n1")), "hub")
        .filter(_sizes_fit(percent)).select("g", "hub")
    )
    to_hub = met.join(first, "hub").join(member, F.col("g") == F.col("g2"))
    in_group = member.join(first, F.col("g2") == F.col("hub")).filter("c1 <> c2")
    wanted = [f"{x}{i}" for x in about for i in (1, 2)]
    pairs = candidates(to_hub.select(*wanted).unionByName(in_group.select(*wanted)))
    links = stage(verified(docs, classes, pairs, k, percent), "links")
    labels = stage(connected_components(links), "labels")

    # Round 2: pairs whose ends are not yet connected.
    labelled = stage(
        classes.join(labels, F.col("c") == F.col("node"), "left")
        .select("c", "g", "n", "bits", "wide", F.coalesce("label", "c").alias("label")),
        "labelled",
    )
    number = F.xxhash64("label")
    only = F.when(F.min("c") == F.max("c"), F.first("bits"))  # a bitmap speaks for one class
    spans = labelled.groupBy("g").agg(
        F.first("n").alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi"), only.alias("bits")
    )
    listed = shared.select("s", "g", "p").join(spans.drop("bits"), "g")
    mixed = (
        listed.groupBy("s").agg(F.min("lo").alias("least"), F.max("hi").alias("most"))
        .filter("least <> most").select("s")
    )
    # Only lists that are still open carry bitmaps.
    listed = stage(
        listed.join(mixed, "s", "left_semi").join(spans.select("g", "bits"), "g"), "open"
    )
    group_pairs = open_pairs(listed, percent).distinct()
    one, two = (ends(labelled, i, "g", *about, "label") for i in (1, 2))
    across = group_pairs.join(one, "g1").join(two, "g2")
    inside = one.join(two, F.col("g1") == F.col("g2")).filter("c1 < c2")
    wanted = [*wanted, "label1", "label2"]
    pairs = candidates(
        across.select(*wanted).unionByName(inside.select(*wanted)).filter("label1 <> label2")
    )
    more = stage(verified(docs, classes, pairs, k, percent), "links")
    contracted = (
        more.join(labelled.select(F.col("c").alias("u"), F.col("label").alias("x")), "u")
        .join(labelled.select(F.col("c").alias("v"), F.col("label").alias("y")), "v")
        .select(F.col("x").alias("u"), F.col("y").alias("v"))
    )
    merged = connected_components(contracted)
    final = (
        labelled.join(merged.withColumnRenamed("label", "top"), F.col("label") == F.col("node"), "left")
        .select("c", F.coalesce("top", "label").alias("label"))
    )
    members = classes.join(final, "c").select("c", "doc_id", "label")
    smallest = members.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_class = members.join(smallest, "label").select(F.col("c").alias("class_c"), "component_id", "label")
    return (
        cut.select("doc_id", "file", "row", "n", "c")
        .join(by_class, (F.col("c") == F.col("class_c")) & (F.col("n") > 0), "left")
        .select(
            "doc_id", "file", "row",
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
            .alias("component_id"),
            "label",
        )
    )


def one_per_group(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay: of each component exactly one row, that with the smallest doc_id,
    null ids last, then the first locator.

    Columns are those of ``docs``. Documents without words all stay.
    """
    rows = located(docs)
    members = stage(
        _decided(rows.select("doc_id", "text", "__file", "__row"), k, percent)
        .filter("label is not null").select("label", "doc_id", "file", "row"),
        "members",
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    keep = (
        members.groupBy(F.col("label").alias("of")).agg(F.count("*").alias("size"), F.min(order).alias("keep"))
        .filter("size > 1").select("of", "keep")
    )
    gone = stage(
        sized_join(members, keep, [F.col("label") == F.col("of")], "inner")
        .filter("not (file = keep.file and row = keep.row)")
        .select(F.col("file").alias("__at"), F.col("row").alias("__nth")),
        "dropped",
    )
    on = [F.col("__file") == F.col("__at"), F.col("__row") == F.col("__nth")]
    return sized_join(rows, gone, on, "left_anti").drop("__file", "__row")
