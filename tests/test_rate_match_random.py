from __future__ import annotations

import datetime
import random

import pytest
from test_anomaly import BILL_SCHEMA, RATE_SCHEMA

from pricing_audit.operators import anomaly

DAY = datetime.date(2025, 1, 1)


def make(seed):
    """Random rates with overlaps and gaps, and transactions a third of which share one key."""
    pick = random.Random(seed)

    def key(hot):
        if pick.random() < hot:
            return ("a", "s", "t", "b")
        return tuple(pick.choice([*options, None]) for options in ("ab", "su", "tv", "bc"))

    def day(low, high):
        return DAY + datetime.timedelta(pick.randint(low, high))

    rates = []
    for n in range(60):
        low = pick.randint(1, 20)
        rates.append((f"C{n % 25:02}", *key(0.2), low, low + pick.randint(0, 15),
                      float(pick.randint(0, 4)), day(0, 40), day(30, 90)))
    billing = []
    for n in range(400):
        price, quantity = pick.randint(0, 8) / 2, pick.randint(1, 36)
        customer, service, temperature, container = key(0.33)
        billing.append((f"T{n % 300}", customer, day(0, 95), service, temperature, container,
                        quantity, price, price * quantity, "PRE_ERP"))
    return billing, rates


def brute_force(billing, rates, single):
    rows = []
    for b in billing:
        fits = [
            r for r in rates
            if None not in r[1:5] and r[1:5] == (b[1], b[3], b[4], b[5])
            and r[5] <= b[6] <= r[6] and r[8] <= b[2] <= r[9]
        ]
        if single and fits:
            fits = [min(fits, key=lambda r: (-r[8].toordinal(), r[0], r[7], r[5], r[6], r[8], r[9]))]
        rows += [(b[0], b[6], b[7], r[0], r[7], r[5]) for r in fits]
        if not fits:
            rows.append((b[0], b[6], b[7], None, None, None))
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("limit", [None, 0], ids=["broadcast", "shuffled"])
def test_against_brute_force(spark, seed, single, limit):
    billing, rates = make(seed)
    matched = anomaly.match_rates(
        spark.createDataFrame(billing, BILL_SCHEMA).repartition(5),
        spark.createDataFrame(rates, RATE_SCHEMA), single=single, limit=limit,
    )
    got = sorted(
        ((r.txn_id, r.quantity, r.billed_unit_price, r.contract_id, r.contract_unit_price,
          r.volume_tier_min) for r in matched.collect()), key=str)
    assert got == brute_force(billing, rates, single)
