"""A search index kept fresh by immutable segments.

Every batch of changes becomes a segment of its own: new and changed sections with their postings, and
a tombstone per removed one. A section counts in the newest segment that names it, so nothing written
earlier is touched. Neighbouring segments of like size are merged, which leaves sizes that at least
halve from one segment to the next: a search reads at most about log2(sections) segments. The list of
segments is a small table per version, written last; a batch that is applied again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import read_if_exists
from .joins import lookup_join
from .search import SearchIndex, build_index


@dataclass(frozen=True)
class Segment:
    """A folder with docs and postings of the batches ``first`` to ``last``; ``sections`` counts its
    docs, tombstones included."""

    folder: str
    first: int
    last: int
    sections: int


class SegmentedIndex:
    def __init__(self, spark: SparkSession, path: str, attributes: Sequence[str] = ()):
        self.spark, self.path, self.attributes = spark, path.rstrip("/"), tuple(attributes)

    def segments(self) -> list[Segment]:
        """The segments of the latest version, oldest first."""
        listed = read_if_exists(self.spark, f"{self.path}/versions")
        if listed is None:
            return []
        newest = listed.filter(F.col("version") == listed.agg(F.max("version").alias("v")).scalar())
        rows = newest.orderBy("first").collect()  # about log2(sections) rows
        return [Segment(r["folder"], r["first"], r["last"], r["sections"]) for r in rows]

    def _docs(self, segment: Segment) -> DataFrame:
        return self.spark.read.parquet(f"{segment.folder}/docs")

    def _postings(self, segment: Segment) -> DataFrame:
        return self.spark.read.parquet(f"{segment.folder}/postings")

    def apply(self, changes: DataFrame, batch: int, text: str = "text", order: str | None = None) -> None:
        """Add a batch of changes: (doc_id, text, attributes..., removed).

        Batches are numbered upwards; one that is not newer than the index is left out, so a replay
        does nothing. Where a batch names a section more than once, the row with the greatest
        ``order`` counts, then a removal, then the greatest text. A section without an id cannot be
        replaced or removed.
        """
        segments = self.segments()
        if segments and batch <= segments[-1].last:
            return
        rank = [F.desc_nulls_last(order)] if order else []
        newest = Window.partitionBy("doc_id").orderBy(*rank, F.desc("removed"), F.desc_nulls_last(text))
        latest = changes.withColumn("__nth", F.row_number().over(newest)).filter("__nth = 1").drop("__nth")
        built = build_index(latest.filter("not removed"), text, self.attributes)
        gone = latest.filter("removed").select("doc_id", F.lit(True).alias("removed"))
        docs = built.docs.withColumn("removed", F.lit(False)).unionByName(gone, allowMissingColumns=True)
        made = self._written(docs, built.postings, batch, batch)
        self._commit(self._merged([*segments, made]), batch)

    def _written(self, docs: DataFrame, postings: DataFrame, first: int, last: int) -> Segment:
        folder = f"{self.path}/segments/{first}-{last}-{scratch_path(self.spark, 's').rsplit('-', 1)[1]}"
        docs.write.parquet(f"{folder}/docs")
        postings.write.parquet(f"{folder}/postings")
        return Segment(folder, first, last, self.spark.read.parquet(f"{folder}/docs").count())

    def _merged(self, segments: list[Segment]) -> list[Segment]:
        """Segments whose sizes at least halve from one to the next; merges take the newest first."""
        while len(segments) > 1 and segments[-2].sections < 2 * segments[-1].sections:
            old, new = segments[-2:]
            named = self._docs(new).select("doc_id")
            docs = lookup_join(self._docs(old), named, ["doc_id"], "left_anti").unionByName(self._docs(new))
            if len(segments) == 2:  # nothing older is left that a tombstone could hide
                docs = docs.filter("not removed")
            postings = lookup_join(self._postings(old), named, ["doc_id"], "left_anti")
            both = postings.unionByName(self._postings(new))
            segments = [*segments[:-2], self._written(docs, both, old.first, new.last)]
        return segments

    def _commit(self, segments: list[Segment], batch: int) -> None:
        rows = [(s.folder, s.first, s.last, s.sections) for s in segments]
        listed = self.spark.createDataFrame(rows, "folder string, first long, last long, sections long")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/version={batch}")

    def index(self) -> SearchIndex:
        """The sections as they now are, for ``search.search``: of each segment what no newer one
        names, without tombstones."""
        segments = self.segments()
        if not segments:
            raise ValueError("nothing has been indexed yet")
        docs, postings, newer = [], [], None
        for segment in reversed(segments):
            own_docs, own_postings = self._docs(segment), self._postings(segment)
            named = own_docs.select("doc_id")
            if newer is not None:
                own_docs = lookup_join(own_docs, newer, ["doc_id"], "left_anti")
                own_postings = lookup_join(own_postings, newer, ["doc_id"], "left_anti")
            docs.append(own_docs.filter("not removed").drop("removed"))
            postings.append(own_postings)
            newer = named if newer is None else newer.unionByName(named)
        union = lambda parts: reduce(DataFrame.unionByName, parts)
        return SearchIndex(union(docs), union(postings))
