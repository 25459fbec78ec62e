from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.functions.measures import average_order_value, return_rate
from tillroll.operators import checks, marts, silver


@pytest.fixture(scope="module")
def silver_df(raw_lines):
    return silver.silver_lines(raw_lines)


def test_country_mart(silver_df):
    rows = {r["Country"]: r.asDict() for r in marts.country_sales(silver_df).collect()}
    uk, au, fr = rows["United Kingdom"], rows["Australia"], rows["France"]
    assert (uk["Orders"], uk["Customers"], uk["UnitsSold"], uk["ReturnUnits"]) == (3, 1, 24, 3)
    assert uk["GrossSales"] == Decimal("114.00") and uk["ReturnAmount"] == Decimal("3.75")
    assert uk["NetRevenue"] == Decimal("110.25")
    # cancelled lines count only as cancelled, whatever their sign
    assert (au["UnitsSold"], au["ReturnUnits"], au["CancelledAmount"]) == (0, 0, Decimal("40.40"))
    assert au["NetRevenue"] == Decimal("-40.40")
    # zero and unknown quantities move nothing
    assert (fr["Orders"], fr["Customers"], fr["UnitsSold"]) == (6, 2, 1007)
    assert fr["GrossSales"] == Decimal("124.00")
    assert [fr["CountryRank"], uk["CountryRank"], au["CountryRank"]] == [1, 2, 3]


def test_product_mart(silver_df):
    rows = {r["StockCode"]: r.asDict() for r in marts.product_performance(silver_df).collect()}
    heart = rows["85123A"]
    assert (heart["Description"], heart["Orders"], heart["UnitsSold"]) == ("CREAM HEART", 1, 12)
    assert heart["GrossSales"] == Decimal("30.60")
    assert rows["21232"]["ReturnRate"] == Decimal("0.00")  # nothing sold
    assert rows["22111"]["Description"] == ""  # only a blank description exists
    ranks = sorted(r["RevenueRank"] for r in rows.values())
    assert ranks == list(range(1, len(rows) + 1))
    assert rows["ADJUST"]["RevenueRank"] == 1


def test_customer_mart(silver_df):
    rows = {(r["Customer ID"], r["Country"]): r.asDict()
            for r in marts.customer_mart(silver_df).collect()}
    assert set(rows) == {("13085", "United Kingdom"), ("16321", "Australia"),
                         ("13078", "France"), ("12682", "France")}
    assert rows[("13085", "United Kingdom")]["AverageOrderValue"] == Decimal("57.00")
    assert rows[("16321", "Australia")]["AverageOrderValue"] == Decimal("0.00")
    assert rows[("13078", "France")]["Orders"] == 4
    assert rows[("13078", "France")]["AverageOrderValue"] == Decimal("4.50")
    assert rows[("12682", "France")]["UnitsPurchased"] == 3


def test_daily_mart_keeps_unknown_dates(silver_df):
    d = marts.daily_sales(silver_df)
    assert d.columns[:5] == ["SaleDate", "Year", "Month", "MonthName", "Country"]
    rows = d.collect()
    assert {r["MonthName"] for r in rows if r["SaleDate"] is not None} == {"December"}
    nulls = [r for r in rows if r["SaleDate"] is None]
    assert len(nulls) == 1 and nulls[0]["Year"] is None and nulls[0]["UnitsSold"] == 2


def test_half_up_rounding(spark):
    df = spark.createDataFrame(
        [(1, 3), (1, 8), (1, 20000), (1, 40000), (2, 3), (0, 0)], "ReturnUnits long, UnitsSold long"
    )
    got = [r[0] for r in df.select(return_rate()).collect()]
    assert got == [Decimal("33.33"), Decimal("12.50"), Decimal("0.01"), Decimal("0.00"),
                   Decimal("66.67"), Decimal("0.00")]
    money = spark.createDataFrame(
        [(Decimal("10.005"), 1), (Decimal("1.00"), 3), (Decimal("2.00"), 3), (Decimal("5"), 0)],
        "GrossSales decimal(28,4), Orders long",
    )
    got = [r[0] for r in money.select(average_order_value()).collect()]
    assert got == [Decimal("10.01"), Decimal("0.33"), Decimal("0.67"), Decimal("0.00")]


def test_marts_reconcile_exactly(silver_df):
    rec = checks.reconciliation(silver_df, marts.all_marts(silver_df, ranked=False))
    rows = rec.collect()
    assert len(rows) == 24
    assert all(r["Passed"] and r["Difference"] == 0 for r in rows)


def _totals(mart_frames):
    """What the layer run observes while it writes each mart."""
    from functools import reduce

    rows = [df.agg(*checks.totals_metrics(m)).select(F.lit(m).alias("Mart"), "*") for m, df in mart_frames.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def test_gate_fails_on_corrupted_mart(silver_df):
    good = marts.all_marts(silver_df, rounded=False)
    checks.enforce(checks.gate_rows(silver_df, _totals(good)), "gate")
    published = {m: marts.publish(df, m) for m, df in good.items()}
    checks.enforce(checks.published_checks(checks.stats_table(published), _totals(good)), "published")
    more = F.when(F.col("RevenueRank") == 1, F.col("UnitsSold") + 5).otherwise(F.col("UnitsSold"))
    bad = good | {"product": good["product"].withColumn("UnitsSold", more)}
    with pytest.raises(checks.ValidationError):
        checks.enforce(checks.gate_rows(silver_df, _totals(bad)), "gate")
    with pytest.raises(checks.ValidationError):
        checks.enforce(checks.published_checks(checks.stats_table(published), _totals(bad)), "published")


def test_grain_and_rank_checks(silver_df):
    m = marts.all_marts(silver_df)
    assert all(r["Passed"] for r in checks.grain_checks(m).collect())
    assert all(r["Passed"] for r in checks.rank_checks(m).collect())
    dup = dict(m)
    dup["country"] = m["country"].unionByName(m["country"].limit(1))
    failed = {r["Mart"] for r in checks.grain_checks(dup).collect() if not r["Passed"]}
    assert failed == {"country"}
    assert not all(r["Passed"] for r in checks.rank_checks(dup).collect())


def test_top_k_equals_full_rank_prefix(spark):
    import datetime as dt

    from tillroll.schemas import RAW_SCHEMA

    ts = dt.datetime(2010, 1, 4, 8, 0)
    rows = [(str(100 + i), f"{20000 + i % 37:05d}", "X", 1 + i % 3, ts, Decimal("2.00"),
             f"{i % 11}.0", "UK") for i in range(300)]
    s = silver.silver_lines(spark.createDataFrame(rows, RAW_SCHEMA))
    full = {r["StockCode"]: r.asDict() for r in marts.product_performance(s).collect()
            if r["RevenueRank"] <= 5}
    top = {r["StockCode"]: r.asDict() for r in marts.top_products(s, k=5).collect()}
    assert top == full
    fullc = [r.asDict() for r in marts.customer_mart(s).collect() if r["CustomerRank"] <= 4]
    topc = [r.asDict() for r in marts.top_customers(s, k=4).collect()]
    assert sorted(topc, key=lambda r: r["CustomerRank"]) == sorted(fullc, key=lambda r: r["CustomerRank"])
