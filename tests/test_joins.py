from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pricing_audit.operators import joins


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows share one key, another part has no key, many are equal copies."""
    n = F.col("id")
    left = spark.range(6000, numPartitions=6).select(
        F.when(n % 3 == 0, "hot").when(n % 10 == 1, None).otherwise((n % 50).cast("string"))
        .alias("k"),
        F.when(n % 6 == 0, 7).otherwise(n).alias("v"),
    )
    right = spark.range(80).select(
        F.when(F.col("id") < 2, "hot").otherwise((F.col("id") % 45).cast("string")).alias("k"),
        F.col("id").alias("w"),
    )
    return left.cache(), right.cache()


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [None, 0])
def test_same_rows_as_plain_join(sides, how, limit):
    left, right = sides
    got = joins.lookup_join(left, right, ["k"], how, limit=limit)
    assert bag(got) == bag(left.join(right, "k", how).select(*got.columns))


def test_range_condition(sides):
    left, right = sides
    condition = F.col("v") >= F.col("w") * 100
    want = left.join(
        right.withColumnRenamed("k", "rk"), (F.col("k") == F.col("rk")) & condition, "left"
    ).drop("rk")
    for limit in (None, 0):
        assert bag(joins.lookup_join(left, right, ["k"], "left", condition, limit)) == bag(want)


def test_building_a_join_runs_nothing(spark, sides):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    joins.lookup_join(*sides, ["k"])
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abcd", [1.0, 2.0], 3), (None, None, 4)],
                               "s string, v array<double>, n int")
    assert joins.measured_bytes(df) >= 4 + 16 + 16
    assert not joins.fits_broadcast(df, 10)
    assert joins.fits_broadcast(df.limit(0), 0)


def test_bad_join_type(sides):
    with pytest.raises(ValueError):
        joins.lookup_join(*sides, ["k"], "outer")


def test_key_types_must_agree(spark, sides):
    other = sides[1].withColumn("k", F.lit(1))
    with pytest.raises(TypeError):
        joins.lookup_join(sides[0], other, ["k"])
