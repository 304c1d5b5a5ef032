from __future__ import annotations

import datetime
import random

from pricing_audit.operators import anomaly
from pricing_audit.session import scratch_path
from pricing_audit.sources import sample
from pricing_audit.streaming import summaries
from pyspark.sql import functions as F

SCHEMA = (
    "customer_name string, anomaly_type string, total_amount double, revenue_impact double,"
    " price_variance_pct double, txn_date date, change long, n int"
)


def bag(df):
    return sorted(map(str, df.collect()))


def random_rows(rng, n):
    some = lambda x: None if rng.random() < 0.1 else x
    return [
        (some(rng.choice("ab")), some(rng.choice(["OVERCHARGE", "OK"])), some(rng.randint(1, 999) / 100),
         some(rng.randint(-999, 999) / 100), some(rng.randint(-99, 99) / 7),
         some(datetime.date(2025, 1, 1) + datetime.timedelta(days=rng.randrange(20))), 1, 0)
        for _ in range(n)
    ]


def test_every_batch_equals_the_summary_of_what_is_left(spark):
    rng, root, live = random.Random(4), scratch_path(spark, "summaries"), []
    for number in range(4):
        fresh = random_rows(rng, 40)
        gone = rng.sample(live, len(live) if number == 3 else len(live) // 2)
        rows = fresh if number < 3 else []
        for r in gone:
            live.remove(r)
        live += rows
        changes = spark.createDataFrame(rows + [(*r[:6], -1, 0) for r in gone], SCHEMA)
        changes.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        summaries.stream_summary(stream, f"{root}/state", f"{root}/checkpoint").awaitTermination()
        want = anomaly.anomaly_summary(spark.createDataFrame(live, SCHEMA))
        assert bag(summaries.current_summary(spark, f"{root}/state")) == bag(want)
    assert not live


def test_a_replayed_batch_replaces_itself(spark):
    root, taken = scratch_path(spark, "summaries"), []
    rows = spark.createDataFrame(random_rows(random.Random(5), 30), SCHEMA)
    rows.coalesce(1).write.parquet(f"{root}/in")

    def run(checkpoint):
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        summaries.stream_summary(stream, f"{root}/state", f"{root}/{checkpoint}").awaitTermination()
        taken.append(bag(summaries.current_summary(spark, f"{root}/state")))

    run("one")
    run("two")  # batch 0 again
    assert taken[0] == taken[1] == bag(anomaly.anomaly_summary(rows))


def test_amendments_in_any_order(spark):
    billing, card = sample.transactions(spark), sample.rates(spark)
    contracts = sorted(r.contract_id for r in card.select("contract_id").distinct().collect())
    want = bag(anomaly.billing_anomalies(billing, card))
    for order in (contracts, contracts[::-1]):
        known = card.filter(F.col("contract_id") == order[0])
        rows = anomaly.billing_anomalies(billing, known).withColumn("change", F.lit(1).cast("long"))
        for contract in order[1:]:
            late = card.filter(F.col("contract_id") == contract)
            rows = rows.unionByName(anomaly.amendment_feed(billing, known, late))
            known = known.unionByName(late)
        names = [c for c in rows.columns if c != "change"]
        left = rows.repartition("txn_id").groupBy(*names).agg(F.sum("change").alias("change")).filter("change <> 0")
        assert left.filter("change <> 1").count() == 0
        assert bag(left.drop("change")) == want


def test_untouched_keys_are_not_rated_again(spark):
    billing, card = sample.transactions(spark), sample.rates(spark)
    none = card.limit(0)
    assert anomaly.amendment_feed(billing, card, none).count() == 0
