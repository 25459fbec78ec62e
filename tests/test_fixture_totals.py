"""Totals measured independently at sf0.01 (FIXTURES.md §5) reproduced
by the library."""
from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from tillroll.operators import checks, marts, profile, silver
from tillroll.sources.testtables import retail_lines


@pytest.fixture(scope="module")
def layers(spark):
    raw = retail_lines(spark, SF_ORACLE)
    s = silver.silver_lines(raw)
    return raw, s, marts.all_marts(s, ranked=False)


def test_raw_counts(layers):
    raw, _, _ = layers
    o = profile.raw_overview(raw).first()
    assert o["TotalRows"] == 61949
    assert o["NullCustomerID"] == 12420 and o["NullDescription"] == 1501
    assert o["CancelledRows"] == 1176 and o["NegativeQuantityRows"] == 7229
    assert o["ZeroPriceRows"] + o["NegativePriceRows"] == 2966
    assert profile.duplicate_rows(raw).first()["DistinctRows"] == 60000


def test_silver_classes(layers):
    _, s, _ = layers
    got = {(r["TransactionType"], r["IsReturn"]): r["count"]
           for r in s.groupBy("TransactionType", "IsReturn").count().collect()}
    assert got[("Normal", False)] == 49267 and got[("Normal", True)] == 5566
    assert sum(v for (t, _), v in got.items() if t == "Cancelled") == 1103


def test_totals_and_mart_sizes(layers):
    _, s, m = layers
    rec = {r["Metric"]: r["SourceValue"] for r in
           checks.reconciliation(s, {"product": m["product"]}).collect()}
    assert rec["UnitsSold"] == 1251150 and rec["ReturnUnits"] == 141533
    assert rec["GrossSales"] == Decimal("1188635730.60")
    assert rec["ReturnAmount"] == Decimal("134324919.00")
    assert rec["CancelledAmount"] == Decimal("26960023.20")
    sizes = {k: v.count() for k, v in m.items()}
    assert sizes == {"daily": 13016, "product": 1960, "customer": 1200, "country": 25}
    negative = {r["Mart"]: r["NegativeRows"] for r in checks.negative_net(m).collect()}
    assert negative == {"product": 9, "customer": 60, "country": 1}
    assert m["product"].filter(F.col("UnitsSold") == 0).count() == 9
