"""Randomized checks: exact rounding against Python decimals, rank
properties, Parquet raw input."""
from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.measures import average_order_value, return_rate, round_money
from tillroll.operators.ranking import SortKey, rank_global, rank_rows
from tillroll.sources.raw import conform_raw


def _half_up(x: Decimal) -> Decimal:
    return x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def test_return_rate_matches_decimal_half_up(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randint(0, 5000), rnd.randint(1, 5000)) for _ in range(3000)]
    pairs += [(1, 20000), (1, 40000), (3, 8), (5, 16), (0, 7)]
    df = spark.createDataFrame(pairs, "ReturnUnits long, UnitsSold long")
    got = [r[0] for r in df.select(return_rate()).collect()]
    want = [_half_up(Decimal(ru) * 100 / Decimal(us)) for ru, us in pairs]
    assert got == want


def test_average_order_value_matches_decimal_half_up(spark):
    rnd = random.Random(12)
    rows = [(Decimal(rnd.randint(0, 10**9)) / 10000, rnd.randint(1, 400)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "GrossSales decimal(28,4), Orders long")
    got = [r[0] for r in df.select(average_order_value()).collect()]
    want = [_half_up(g / Decimal(o)) for g, o in rows]
    assert got == want


def test_round_money_is_half_away_from_zero(spark):
    vals = [Decimal("1.005"), Decimal("-1.005"), Decimal("2.0049"), Decimal("-2.0050"), Decimal("0.0000")]
    df = spark.createDataFrame([(v,) for v in vals], "v decimal(28,4)")
    got = [r[0] for r in df.select(round_money("v")).collect()]
    assert got == [Decimal("1.01"), Decimal("-1.01"), Decimal("2.00"), Decimal("-2.01"), Decimal("0.00")]


@settings(max_examples=8, deadline=None)
@given(
    revenues=st.lists(st.sampled_from([None, -5, 0, 0, 0, 1, 2, 2, 7]), min_size=1, max_size=120),
    buckets=st.integers(min_value=2, max_value=9),
)
def test_distributed_rank_is_the_global_rank(spark, revenues, buckets):
    rows = [(f"k{i:04d}", None if r is None else Decimal(r)) for i, r in enumerate(revenues)]
    df = spark.createDataFrame(rows, "Key string, NetRevenue decimal(28,4)")
    keys = [SortKey("NetRevenue", descending=True), SortKey("Key")]
    want = {r["Key"]: r["Rank"] for r in rank_global(df, keys, "Rank").collect()}
    got = {r["Key"]: r["Rank"] for r in
           rank_rows(df, keys, "Rank", ranges=buckets).collect()}
    assert got == want
    assert sorted(got.values()) == list(range(1, len(rows) + 1))


def test_conform_raw_from_parquet_types(spark):
    df = spark.createDataFrame(
        [("C1", "85048", "X", 2.0, "2009-12-01 07:45:00", 6.95, "1.0", "UK"),
         ("2", "85049", None, None, "bad", 0.00049, None, None)],
        "Invoice string, StockCode string, Description string, Quantity double, "
        "InvoiceDate string, Price double, `Customer ID` string, Country string",
    )
    out = conform_raw(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "string", "string", "string", "int", "timestamp_ntz", "decimal(14,4)", "string", "string"]
    rows = out.collect()
    assert rows[0]["Price"] == Decimal("6.9500") and rows[0]["Quantity"] == 2
    assert rows[1]["InvoiceDate"] is None and rows[1]["Price"] == Decimal("0.0005")
    assert out.filter(F.col("Quantity").isNull()).count() == 1
