"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """True if every child has one parent and no parent is itself a child."""
    several = edges.groupBy("u").count().filter("count > 1").select("u")
    chained = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return several.unionByName(chained).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v); label is the component's smallest node.

    Each round attaches neighbours to the smallest node seen around them, so the depth halves or
    better; rounds are written to the shared folder, which cuts lineage. Self loops and repeated
    edges are fine, edges with a null end are ignored, and no edges give no rows. Hubs are safe:
    minima are pre-aggregated before the shuffle, and the joins can be split by adaptive execution.
    """
    edges = stage(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    while not _is_forest_of_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(parent, "u").filter("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        small = moved.unionByName(parent.withColumnRenamed("m", "v")).distinct()
        edges = stage(small, "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
