from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from pricing_audit.operators import anomaly, metrics
from pricing_audit.sources import sample, tables

D = datetime.date


@pytest.fixture(scope="module")
def flagged(spark):
    return anomaly.billing_anomalies(sample.transactions(spark), sample.rates(spark)).cache()


def test_sample_sizes(spark):
    counts = tables.row_counts(
        contracts=sample.contracts(spark), rates=sample.rates(spark),
        transactions=sample.transactions(spark),
    )
    assert {r.table_name: r.row_count for r in counts.collect()} == {
        "contracts": 5, "rates": 38, "transactions": 32}


def test_published_summary(flagged):
    rows = {
        (r.customer_name, r.anomaly_type):
            (r.txn_count, r.total_billed, r.total_revenue_impact, r.avg_variance_pct)
        for r in anomaly.anomaly_summary(flagged).collect()
    }
    assert rows == {
        ("BioPharm Corp", "OVERCHARGE"): (2, 2000.0, 417.5, 24.04),
        ("BioPharm Corp", "UNDERCHARGE"): (2, 870.0, -300.0, -25.0),
        ("BioPharm Corp", "WITHIN_TOLERANCE"): (8, 5200.0, 0.0, 0.0),
        ("CryoMed Research", "OVERCHARGE"): (2, 3155.0, 510.0, 19.84),
        ("CryoMed Research", "UNDERCHARGE"): (2, 725.0, -332.5, -30.08),
        ("CryoMed Research", "WITHIN_TOLERANCE"): (6, 3400.0, 0.0, 0.0),
        ("GeneTech Solutions", "OVERCHARGE"): (1, 1375.0, 250.0, 22.22),
        ("GeneTech Solutions", "UNDERCHARGE"): (2, 375.0, -150.0, -29.165),
        ("GeneTech Solutions", "WITHIN_TOLERANCE"): (7, 6685.0, 0.0, 0.0),
    }


def test_top_ten_and_reports(flagged):
    top = [(r.txn_id[-3:], r.revenue_impact) for r in anomaly.top_anomalies(flagged).collect()]
    assert top == [
        ("028", 375.0), ("008", 337.5), ("017", 250.0), ("030", -250.0), ("007", -210.0),
        ("027", 135.0), ("009", -90.0), ("029", -82.5), ("006", 80.0), ("018", -75.0),
    ]
    impact = {r.customer_name: r.total_overcharge_impact
              for r in metrics.overcharge_impact(flagged).collect()}
    assert impact == {"CryoMed Research": 510.0, "BioPharm Corp": 417.5,
                      "GeneTech Solutions": 250.0}
    assert anomaly.review_queue(flagged).count() == 5
    assert metrics.customer_anomalies(flagged, "BioPharm Corp").count() == 4
    wide = {r.customer_name: r for r in metrics.anomaly_pivot(flagged).collect()}
    assert wide["GeneTech Solutions"].undercharge_count == 2
    assert wide["GeneTech Solutions"].no_contract_match_count == 0
    assert anomaly.alerts(flagged, 250.0).count() == 4


RATE_SCHEMA = (
    "contract_id string, customer_name string, service_type string, temperature string, "
    "container_size string, volume_tier_min int, volume_tier_max int, unit_price double, "
    "effective_date date, expiry_date date"
)
BILL_SCHEMA = (
    "txn_id string, customer_name string, txn_date date, service_type string, "
    "temperature string, container_size string, quantity int, billed_unit_price double, "
    "total_amount double, erp_status string"
)


def edge_tables(spark):
    rates = spark.createDataFrame([
        ("C1", "acme", "S", "RT", "BOX", 1, 10, 100.0, D(2025, 1, 1), D(2025, 6, 30)),
        ("C1", "acme", "S", "RT", "BOX", 11, 20, 0.0, D(2025, 1, 1), D(2025, 6, 30)),
        ("C2", "acme", "S", "LN2", "BOX", 1, 10, 50.0, D(2025, 1, 1), D(2025, 12, 31)),
        ("C3", "acme", "S", "LN2", "BOX", 1, 10, 40.0, D(2025, 3, 1), D(2025, 12, 31)),
        ("C4", "acme", "S", "LN2", "BOX", 1, 10, 30.0, D(2025, 3, 1), D(2025, 12, 31)),
        ("C5", "acme", "S", "BAD", "BOX", None, 10, 30.0, D(2025, 3, 1), D(2025, 12, 31)),
    ], RATE_SCHEMA)

    def bill(name, temperature, quantity, price, day=D(2025, 3, 1), customer="acme"):
        return (name, customer, day, "S", temperature, "BOX", quantity, price, quantity * price,
                "PRE_ERP")

    billing = spark.createDataFrame([
        bill("zero-zero", "RT", 15, 0.0),
        bill("zero-rate", "RT", 15, 2.0),
        bill("plus-one", "RT", 5, 101.0),
        bill("minus-one", "RT", 5, 99.0),
        bill("over", "RT", 5, 101.01),
        bill("tier-min", "RT", 1, 100.0),
        bill("tier-max", "RT", 10, 100.0),
        bill("above-tiers", "RT", 21, 100.0),
        bill("first-day", "RT", 5, 100.0, D(2025, 1, 1)),
        bill("last-day", "RT", 5, 100.0, D(2025, 6, 30)),
        bill("too-late", "RT", 5, 100.0, D(2025, 7, 1)),
        bill("null-key", None, 5, 100.0),
        bill("null-customer", "RT", 5, 100.0, customer=None),
        bill("null-bound", "BAD", 5, 30.0),
        bill("overlap", "LN2", 5, 40.0),
        bill("overlap", "LN2", 5, 40.0),
    ], BILL_SCHEMA)
    return billing, rates


EXPECTED = {
    "zero-zero": {(None, "C1")},
    "zero-rate": {("OVERCHARGE", "C1")},
    "plus-one": {("WITHIN_TOLERANCE", "C1")},
    "minus-one": {("WITHIN_TOLERANCE", "C1")},
    "over": {("OVERCHARGE", "C1")},
    "tier-min": {("WITHIN_TOLERANCE", "C1")},
    "tier-max": {("WITHIN_TOLERANCE", "C1")},
    "above-tiers": {("NO_CONTRACT_MATCH", None)},
    "first-day": {("WITHIN_TOLERANCE", "C1")},
    "last-day": {("WITHIN_TOLERANCE", "C1")},
    "too-late": {("NO_CONTRACT_MATCH", None)},
    "null-key": {("NO_CONTRACT_MATCH", None)},
    "null-customer": {("NO_CONTRACT_MATCH", None)},
    "null-bound": {("NO_CONTRACT_MATCH", None)},
    "overlap": {("UNDERCHARGE", "C2"), ("WITHIN_TOLERANCE", "C3"), ("OVERCHARGE", "C4")},
}


@pytest.mark.parametrize("limit", [None, 0], ids=["broadcast", "shuffled"])
def test_edges(spark, limit):
    billing, rates = edge_tables(spark)
    rows = anomaly.billing_anomalies(billing, rates, limit=limit).collect()
    found = {}
    for r in rows:
        found.setdefault(r.txn_id, set()).add((r.anomaly_type, r.contract_id))
    assert found == EXPECTED
    assert len(rows) == billing.count() + 4


@pytest.mark.parametrize("limit", [None, 0], ids=["broadcast", "shuffled"])
def test_single_match(spark, limit):
    billing, rates = edge_tables(spark)
    rows = anomaly.billing_anomalies(billing, rates, single=True, limit=limit).collect()
    assert len(rows) == billing.count()
    assert [r.contract_id for r in rows if r.txn_id == "overlap"] == ["C3", "C3"]
    inner = anomaly.match_rates(billing, rates, how="inner", single=True, limit=limit)
    assert inner.count() == sum(
        1 for r in billing.collect() if EXPECTED[r.txn_id] != {("NO_CONTRACT_MATCH", None)})


def test_slide_variant(spark):
    billing, rates = edge_tables(spark)
    matched = anomaly.match_rates(
        billing.drop("service_type"), rates, date=None, how="inner",
        keys=("customer_name", "temperature", "container_size"),
    )
    classes = {
        (r.txn_id, r.contract_id): r.anomaly_type
        for r in anomaly.classify(anomaly.with_variance(matched), two_sided=True).collect()
    }
    assert classes[("too-late", "C1")] is None
    assert classes[("plus-one", "C1")] is None
    assert classes[("over", "C1")] == "OVERCHARGE"
    assert ("null-bound", "C5") not in classes


def test_invariants(spark, flagged):
    total = flagged.agg(F.sum(F.col("revenue_impact").cast("decimal(18,2)")).alias("s")).first().s
    summary = anomaly.anomaly_summary(flagged).agg(
        F.sum("txn_count").alias("n"),
        F.sum(F.col("total_revenue_impact").cast("decimal(18,2)")).alias("s")).first()
    assert (summary.n, summary.s) == (32, total)


def test_rate_history(spark):
    _, rates = edge_tables(spark)
    rows = {r.contract_id: r for r in anomaly.rate_history(rates).collect()
            if r.temperature == "LN2"}
    assert rows["C2"].closed_date == D(2025, 2, 28) and not rows["C2"].is_current
    assert rows["C3"].closed_date == D(2025, 12, 31) and rows["C4"].is_current


def test_metric_layer(spark, flagged):
    result = metrics.metric_query(
        flagged, metrics.ANOMALY_VIEW, ["anomaly_type"], ["revenue_impact"],
        {"customer_name": "BioPharm Corp"}, ["-sum_revenue_impact"], 1).collect()
    assert [(r.anomaly_type, r.row_count, r.sum_revenue_impact) for r in result] == [
        ("OVERCHARGE", 2, 417.5)]
    with pytest.raises(KeyError):
        metrics.metric_query(flagged, metrics.ANOMALY_VIEW, ["unit_price"])
    with pytest.raises(KeyError):
        metrics.metric_query(flagged, metrics.ANOMALY_VIEW, [], [], {"nope": 1})
    odd = metrics.filtered(flagged, customer_name="x' OR '1'='1", temperature=None)
    assert odd.count() == 0
    assert metrics.filtered(flagged, customer_name="All", quantity=[50, 80]).count() == 4


def test_plans(spark):
    billing, rates = edge_tables(spark)
    plan = anomaly.billing_anomalies(billing, rates, limit=10**7)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    wide = anomaly.billing_anomalies(billing, rates, limit=0)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in wide and "BroadcastNestedLoopJoin" not in wide
