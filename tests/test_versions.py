from __future__ import annotations

import datetime
import random

from pricing_audit.operators import pages
from pricing_audit.session import scratch_path
from pricing_audit.streaming import versions

SCHEMA = "filename string, customer_id string, text string, modified_at timestamp, page_index int"


def bag(df):
    return sorted(map(str, df.drop("parsed_at").collect()))


def arrive(spark, root, rows, times=True, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df if times else df.drop("modified_at")
    df.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
    versions.stream_page_versions(stream, f"{root}/cache", f"{root}/checkpoint", **options).awaitTermination()
    return versions.current_pages(spark, f"{root}/cache")


def at(n):
    return None if n is None else datetime.datetime(2025, 1, 1) + datetime.timedelta(hours=n)


def test_changed_texts_replace_their_pages(spark):
    root = scratch_path(spark, "versions")
    long = "\n".join("abcdefgh")
    first = [("a", "x", long, at(1), 0), ("a", "y", "shared", at(1), 0), ("b", "x", "b", at(1), 0), ("b", "x", "b", at(1), 0)]
    assert len(bag(arrive(spark, root, first))) == 4
    # Known, changed to fewer pages, changed to none, late and older, new.
    second = [("a", "y", "shared", at(5), 0), ("a", "x", "short", at(2), 0), ("b", "x", None, at(3), 0), ("c", "z", "new", at(1), 0)]
    arrive(spark, root, second)
    third = [("a", "x", "older", at(0), 0)]
    current = arrive(spark, root, third)
    got = [(r.filename, r.customer_id, r.page_text, r.total_pages) for r in current.orderBy("filename", "customer_id").collect()]
    assert got == [("a", "x", "short", 1), ("a", "y", "shared", 1), ("c", "z", "new", 1)]
    # Only changed texts were parsed again.
    parsed = spark.read.parquet(f"{root}/cache/documents").filter("batch_id > 0").collect()
    assert sorted((r.filename, r.customer_id) for r in parsed) == [("a", "x"), ("b", "x"), ("c", "z")]


def test_any_order_equals_batch(spark):
    rng, rows = random.Random(3), []
    for i in range(120):
        text = rng.choice([None, "", f"line {rng.randrange(6)}", "\n".join(f"l{j}" for j in range(rng.randint(1, 12)))])
        rows.append((rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), text, at(rng.choice([None, *range(9)])), i))
    batch = pages.split_pages(versions.latest_documents(spark.createDataFrame(rows, SCHEMA)))
    rng.shuffle(rows)
    root = scratch_path(spark, "versions")
    for part in (rows[:50], rows[50:90], rows[90:], rows[:10]):
        current = arrive(spark, root, part)
    assert bag(current) == bag(batch)


def test_a_batch_does_not_read_the_cache(spark):
    root = scratch_path(spark, "versions")
    arrive(spark, root, [("a", "x", "one", None, 0)], times=False)
    # Without its earlier pages the next batch must still know the document.
    spark.createDataFrame([], "filename string, customer_id string").write.mode("overwrite").parquet(f"{root}/cache/documents/batch_id=0")
    arrive(spark, root, [("a", "x", "one", None, 0), ("d", "x", "two", None, 0)], times=False)
    seen = spark.read.parquet(f"{root}/cache/documents").collect()
    assert [(r.filename, r.batch_id) for r in seen] == [("d", 1)]


def test_python_is_called_per_group_of_documents(spark):
    """The calls are bounded by the groups, whatever the number of documents, and no document is lost."""
    root = scratch_path(spark, "versions")
    rows = [(f"f{i}", None if i % 5 == 0 else f"c{i % 3}", f"text {i}", at(1), 0) for i in range(400)]
    arrive(spark, root, rows, groups=8)
    later = [(f, c, t if i % 2 else "new " + t, at(2 if i % 4 else 0), 0) for i, (f, c, t, _, _) in enumerate(rows)]
    later += [(f"g{i}", "x", None, at(1), 0) for i in range(20)]
    current = arrive(spark, root, later, groups=8)
    assert bag(current) == bag(pages.split_pages(versions.latest_documents(spark.createDataFrame(rows + later, SCHEMA))))
    seen = spark.read.parquet(f"{root}/cache/documents").groupBy("batch_id").count().collect()
    assert sorted(map(tuple, seen)) == [(0, 400), (1, 100 + 20)]
    stores = spark.read.format("statestore").load(f"{root}/checkpoint")
    assert stores.count() <= 8
