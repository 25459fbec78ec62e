"""Null and edge semantics of Silver and Gold, on hand-made rows."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.operators import enrich, marts, silver
from tillroll.schemas import RAW_SCHEMA

TS = dt.datetime(2010, 3, 1, 9, 0)


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_null_invoice_is_normal_and_null_keys_drop(spark):
    rows = [
        (None, "85048", "A", 2, TS, Decimal("1.5"), "1.0", "UK"),      # null invoice: Normal
        ("1", None, "B", 2, TS, Decimal("1.5"), "1.0", "UK"),          # null stock code: dropped
        ("2", "85049", "C", 2, TS, None, "1.0", "UK"),                 # null price: dropped
        ("C3", "85050", "D", None, TS, Decimal("2.0"), "2.0", "UK"),   # cancelled, null quantity
        ("4", "85051", "E", 3, TS, Decimal("2.0"), "3.0", None),       # null country
    ]
    s = silver.silver_lines(_raw(spark, rows))
    got = {r["Description"]: r for r in s.collect()}
    assert set(got) == {"A", "D", "E"}
    assert got["A"]["TransactionType"] == "Normal"
    assert got["D"]["TransactionType"] == "Cancelled" and got["D"]["Revenue"] is None

    country = {r["Country"]: r for r in marts.country_sales(s).collect()}
    # cancelled line with unknown quantity: abs(null) is skipped by sum
    assert country["UK"]["CancelledAmount"] == Decimal("0.00")
    assert country["UK"]["Orders"] == 1  # the null invoice is not an order
    assert None in country  # a null country is its own group
    product = {r["StockCode"]: r for r in marts.product_performance(s).collect()}
    assert product["85050"]["NetRevenue"] is None  # only a null cancelled amount
    ranks = sorted(r["RevenueRank"] for r in product.values())
    assert ranks == [1, 2, 3]
    assert product["85050"]["RevenueRank"] == 3  # null revenue ranks last


def test_cancelled_positive_quantity_is_not_sold(spark):
    rows = [
        ("C9", "85048", "A", 4, TS, Decimal("2.5"), "7.0", "UK"),
        ("9", "85048", "A", -1, TS, Decimal("2.5"), "7.0", "UK"),
        ("10", "85048", "A", 0, TS, Decimal("2.5"), "7.0", "UK"),
    ]
    base = marts.gold_base(silver.silver_lines(_raw(spark, rows)))
    got = {r["Invoice"]: r for r in base.collect()}
    assert got["C9"]["CancelledAmount"] == Decimal("10.0000") and got["C9"]["SoldUnits"] == 0
    assert got["C9"]["TransactionClass"] == "Cancelled"
    assert got["9"]["ReturnAmount"] == Decimal("2.5000") and got["9"]["TransactionClass"] == "Return"
    assert got["10"]["TransactionClass"] == "Zero"
    p = marts.product_performance(silver.silver_lines(_raw(spark, rows))).first()
    assert (p["UnitsSold"], p["ReturnUnits"], p["ReturnRate"]) == (0, 1, Decimal("0.00"))
    assert p["NetRevenue"] == Decimal("-12.50")


def test_description_prefers_real_text_over_blank(spark):
    rows = [
        ("1", "85048", "   ", 1, TS, Decimal("1"), "1.0", "UK"),
        ("2", "85048", "ZEBRA", 1, TS, Decimal("1"), "1.0", "UK"),
        ("3", "85048", "APPLE", 1, TS, Decimal("1"), "1.0", "UK"),
        ("4", "85048", None, 1, TS, Decimal("1"), "1.0", "UK"),
    ]
    p = marts.product_performance(silver.silver_lines(_raw(spark, rows))).first()
    assert p["Description"] == "APPLE"


def test_tabs_survive_trim(spark):
    rows = [("1", "85048", "\tTAB ", 1, TS, Decimal("1"), "1.0", " UK\t")]
    r = silver.clean_lines(_raw(spark, rows)).first()
    assert r["Description"] == "\tTAB" and r["Country"] == "UK\t"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_is_broadcast_by_its_bytes(spark):
    country = spark.createDataFrame([("UK", 1), ("Mars", 2)], "Country string, Orders int")
    regions = spark.createDataFrame([("UK", "EUROPE")], "_country string, Region string")
    assert sorted(map(tuple, enrich.with_region(country, regions).collect())) == [("Mars", 2, None), ("UK", 1, "EUROPE")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(enrich.with_region(country, regions))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_input_flows_through(spark):
    empty = spark.createDataFrame([], RAW_SCHEMA)
    s = silver.silver_lines(empty)
    m = marts.all_marts(s)
    assert all(df.count() == 0 for df in m.values())
    from tillroll.operators import checks

    rec = checks.reconciliation(s, marts.all_marts(s, ranked=False)).collect()
    assert len(rec) == 24 and all(r["Passed"] for r in rec)
    assert all(r["Passed"] for r in checks.rank_checks(m).collect())
    assert marts.top_products(s).count() == 0
