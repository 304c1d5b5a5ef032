"""Headline queries timed on one data folder; prints a single JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the data, the cores and the repetitions. Each query
runs once to warm up; its figure is the median of the following runs, results fully computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from pricing_audit.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "billing_anomalies", "billing_anomalies_single_match", "anomaly_summary", "top_anomalies",
    "anomaly_pivot", "billed_vs_contract", "metric_query_sample", "split_pages", "keyword_pages",
    "extract_parallel_arrays", "extract_json_rows", "clause_prices", "normalize_prices",
    "validate_prices", "validation_summary", "compare_methods_full", "search_bm25",
    "vector_topk", "rate_history",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    names = list(QUERIES) if names == ["all"] else names
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pricing_audit_bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        seconds = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(seconds[1:]), 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
