"""Derived tables: what is sent to every task is measured, not guessed from the size of files."""

from __future__ import annotations

import pytest
from pricing_audit.sources import testdata

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["billing", "amendments", "shipments"])
def test_tables_beyond_the_limit_are_not_broadcast(spark, monkeypatch, name):
    plan = lambda: getattr(testdata, name)(spark, SF)._jdf.queryExecution().executedPlan().toString()
    rows = getattr(testdata, name)(spark, SF).count()
    monkeypatch.setattr(testdata, "SMALL_BYTES", 100, raising=False)
    assert "Broadcast" not in plan()
    assert getattr(testdata, name)(spark, SF).count() == rows
