"""Skew safety as a plan invariant, and marts on deliberately skewed data.

Every hash shuffle in the aggregation plans must sit directly on a
map-side partial aggregate: then a key holding a third of all rows is
pre-combined in every map task and reaches the reducer as one row per
task, never as a third of the data.
"""
from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest

from tillroll.operators import marts, profile, silver
from tillroll.schemas import RAW_SCHEMA


@pytest.fixture(scope="module")
def skewed_raw(spark):
    ts = dt.datetime(2011, 5, 2, 10, 0)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0  # a third of all lines: one country, one invoice, one product
        rows.append((
            "900000" if hot else str(100000 + i // 5),
            "85123A" if hot else f"{20000 + i % 97:05d}",
            "HOT" if hot else f"ITEM {i % 97}",
            1 + i // 3 if hot else 1 + i % 7,  # hot lines all distinct
            ts,
            Decimal("1.25"),
            "12345.0" if hot else f"{i % 50}.0",
            "United Kingdom" if hot else f"C{i % 9}",
        ))
    return spark.createDataFrame(rows, RAW_SCHEMA).repartition(6)


def _shuffle_children(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            out.append((line.strip()[:80], re.sub(r"^[\s:+|-]*(\*\(\d+\) )?", "", child)[:60]))
    return out


def _plans(raw):
    s = silver.silver_lines(raw)
    return {
        "invoice_grain": marts.invoice_grain(s),
        "daily": marts.daily_sales(s),
        "product": marts.product_unranked(s),
        "customer": marts.customer_unranked(s),
        "country": marts.country_unranked(s),
        "distinct_counts": profile.distinct_counts(raw),
        "duplicate_rows": profile.duplicate_rows(raw),
    }


def test_every_hash_shuffle_is_pre_aggregated(skewed_raw):
    for name, df in _plans(skewed_raw).items():
        children = _shuffle_children(df)
        assert children, name
        for exchange, child in children:
            # a map-side (partial) hash or sort aggregate feeds every shuffle
            assert child.startswith(("HashAggregate", "SortAggregate")), (name, exchange, child)


def test_skewed_marts_are_exact(skewed_raw):
    s = silver.silver_lines(skewed_raw)
    country = {r["Country"]: r for r in marts.country_sales(s).collect()}
    uk = country["United Kingdom"]
    assert uk["Orders"] == 1 and uk["Customers"] == 1
    assert uk["UnitsSold"] == sum(1 + i // 3 for i in range(0, 3000, 3))
    assert uk["CountryRank"] == 1
    product = {r["StockCode"]: r for r in marts.product_performance(s).collect()}
    assert product["85123A"]["Orders"] == 1
    assert sorted(r["RevenueRank"] for r in product.values()) == list(range(1, len(product) + 1))
