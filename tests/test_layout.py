"""Clustered layout, pruning through a join, mergeable distinct counts,
rank proof by bitmaps, exact moments."""

from __future__ import annotations

import glob
import math
import os
import random
from collections import defaultdict
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillroll.operators import distincts, enrich, marts
from tillroll.operators.checks import distinct_ranks, rank_checks
from tillroll.operators.profile import column_stats
from tillroll.sources.layers import read_layer, write_clustered, write_layer


def _scanned_rows(df):
    """Rows that left the scans of a query that has run."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if "FileSourceScan" in kind:
            total += node.metrics().apply("numOutputRows").value()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif "QueryStage" in kind:
            todo.append(node.plan())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return total


def _lines(spark, n=60_000):
    i = F.col("id")
    code = F.when(i % 3 == 0, F.lit("P00000042")).otherwise(F.format_string("P%08d", (i * 7919) % 5000))  # a third is one product
    return spark.range(n).select(code.alias("StockCode"), F.format_string("I%06d", (i * 31) % 20000).alias("Invoice"), i.alias("Line"))


@pytest.fixture()
def many_files(spark):
    """Ranges of a few rows are files of their own, as large ones would be."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_clustered_layout_reads_few_rows_for_one_product(many_files, scratch):
    spark = many_files
    lines = _lines(spark)
    plain, clustered = os.path.join(scratch, "plain"), os.path.join(scratch, "clustered")
    write_layer(lines.repartition(8), plain)
    write_clustered(lines, clustered, ["StockCode", "Invoice"], row_group_bytes=1 << 16)
    assert read_layer(spark, clustered).exceptAll(lines).count() == 0 and read_layer(spark, clustered).count() == 60_000

    def read(path, condition):
        df = read_layer(spark, path).filter(condition)
        return len(df.collect()), _scanned_rows(df)

    product = "StockCode = 'P00001234'"
    found, scanned = read(plain, product)
    again, fewer = read(clustered, product)
    assert found == again > 0 and scanned > 30_000 and fewer < 10_000
    # the hot product is split over files instead of filling one
    sizes = [read_layer(spark, f).filter("StockCode = 'P00000042'").count() for f in glob.glob(clustered + "/*.parquet")]
    assert max(sizes) < 12_000


def test_bloom_filters_skip_files_without_the_value(many_files, scratch):
    """Invoices are not in the order of the files; bloom filters tell."""
    spark = many_files
    path = os.path.join(scratch, "bloom")
    lines = spark.range(60_000).select(
        F.format_string("P%08d", F.col("id") % 5000).alias("StockCode"),
        F.concat(F.lit("I"), F.sha1(F.col("id").cast("string"))).alias("Invoice"))
    write_clustered(lines, path, ["StockCode", "Invoice"])
    one = read_layer(spark, path).filter(F.col("Invoice") == lines.first()["Invoice"])
    assert one.count() == 1
    assert len(one.collect()) == 1 and _scanned_rows(one) < 20_000
    assert all(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(path + "/*.parquet"))


def test_empty_clustered_layout(spark, scratch):
    path = os.path.join(scratch, "none")
    write_clustered(_lines(spark, 10).limit(0), path, ["StockCode"])
    assert read_layer(spark, path).count() == 0


def test_a_filter_on_the_calendar_prunes_the_daily_mart(spark, scratch):
    days = spark.range(730).select(
        F.date_add(F.lit("2009-01-01").cast("date"), F.col("id").cast("int")).alias("SaleDate"), F.lit("UK").alias("Country"),
        F.lit(2).cast("bigint").alias("UnitsSold"), F.lit("1.50").cast("decimal(18,2)").alias("NetRevenue"))
    daily = days.withColumn("Year", F.year("SaleDate")).withColumn("Month", F.month("SaleDate"))
    path, months = os.path.join(scratch, "daily"), os.path.join(scratch, "months")
    write_layer(daily, path, partition_by=["Year", "Month"])
    write_layer(enrich.month_calendar(daily), months)
    assert read_layer(spark, months).count() == 24
    out = enrich.quarter_sales(read_layer(spark, path), read_layer(spark, months).filter("Quarter = 4"))
    got = {r["Year"]: (r["Quarter"], r["Days"], r["UnitsSold"], r["NetRevenue"]) for r in out.collect()}
    assert got == {y: (4, 92, 184, Decimal("138.00")) for y in (2009, 2010)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert _scanned_rows(out) <= 184 + 2 * 24  # the days of six months, and the calendar


# --- distinct counts ------------------------------------------------------------

def _grain(spark, seed=1):
    rnd = random.Random(seed)
    rows = [(f"2010-{rnd.randrange(1, 13):02d}-{rnd.randrange(1, 28):02d}", rnd.choice(["UK", "UK", "FR", None]),
             rnd.choice([None, *map(str, range(400))]), rnd.choice([None, None, *map(str, range(90))])) for _ in range(2500)]
    rows += [("2011-01-01", "DE", "7", None), ("2011-01-02", "DE", None, None), (None, "UK", "1", "1")]
    df = spark.createDataFrame(rows, "d string, Country string, Invoice string, `Customer ID` string")
    return df.select(F.col("d").cast("date").alias("SaleDate"), "Country", "Invoice", "Customer ID")


def _merged(grain, by, bitmaps):
    return sorted(map(tuple, distincts.merged_distincts(bitmaps, by).collect()), key=str)


def _direct(grain, by):
    dated = grain.withColumn("Year", F.year("SaleDate")).withColumn("Month", F.month("SaleDate"))
    counts = dated.groupBy(*by).agg(F.countDistinct("Invoice").alias("o"), F.countDistinct("Customer ID").alias("c"))
    return sorted(map(tuple, counts.collect()), key=str)


@pytest.mark.parametrize("by", [["Country", "Year", "Month"], ["Country"], ["Year"], []])
def test_merged_counts_equal_direct_ones(spark, by):
    grain = _grain(spark)
    numbers = {e: distincts.number_values(grain, c) for e, c in distincts.ENTITIES.items()}
    assert _merged(grain, by, distincts.entity_bitmaps(grain, numbers)) == _direct(grain, by)


def test_numbers_are_dense_and_span_several_stretches(spark):
    grain = spark.range(70_000).select(
        F.lit("2010-01-01").cast("date").alias("SaleDate"), F.lit("UK").alias("Country"),
        F.format_string("I%06d", "id").alias("Invoice"), F.lit("1").alias("Customer ID"))
    numbers = {e: distincts.number_values(grain, c) for e, c in distincts.ENTITIES.items()}
    span = numbers["Orders"].agg(F.min("Number"), F.max("Number"), F.countDistinct("Number")).first()
    assert tuple(span) == (0, 69_999, 70_000)
    bitmaps = distincts.entity_bitmaps(grain, numbers)
    assert bitmaps.filter("Entity = 'Orders'").count() == 3
    assert _merged(grain, ["Country"], bitmaps) == [("UK", 70_000, 1)]


def test_a_new_month_extends_the_stored_sets(spark):
    old, new = _grain(spark, 1), _grain(spark, 2).withColumn("SaleDate", F.add_months("SaleDate", 24))
    numbers = {e: distincts.number_values(old, c) for e, c in distincts.ENTITIES.items()}
    more = {e: distincts.number_values(new, c, numbers[e]) for e, c in distincts.ENTITIES.items()}
    for e in more:
        kept = {r["Value"]: r["Number"] for r in numbers[e].collect()}
        now = {r["Value"]: r["Number"] for r in more[e].collect()}
        assert kept.items() <= now.items() and sorted(now.values()) == list(range(len(now)))
    stored = distincts.entity_bitmaps(old, numbers).unionByName(distincts.entity_bitmaps(new, more))
    assert _merged(None, ["Country"], stored) == _direct(old.unionByName(new), ["Country"])


# --- rank proof --------------------------------------------------------------------

@pytest.mark.parametrize("ranks, distinct", [
    (list(range(1, 70_001)), 70_000), ([1, 2, 2, 4], 3), ([1, 2, 4, 5], 4), ([], 0), ([1, None, 3], 2), ([1, 32_768, 32_769], 3)])
def test_distinct_ranks_from_bitmaps(spark, ranks, distinct):
    df = spark.createDataFrame([(r,) for r in ranks], "RevenueRank bigint").repartition(5)
    assert distinct_ranks(df, "RevenueRank").first()[0] == distinct


def test_a_doubled_and_a_skipped_rank_fail(spark, raw_lines):
    from tillroll.operators.silver import silver_lines

    m = marts.all_marts(silver_lines(raw_lines))
    assert rank_checks(m).filter("NOT Passed").count() == 0
    top = F.col("RevenueRank") == 1
    for bad in (F.when(top, 2).otherwise(F.col("RevenueRank")), F.col("RevenueRank") + F.when(F.col("RevenueRank") > 2, 1).otherwise(0)):
        spoilt = m | {"product": m["product"].withColumn("RevenueRank", bad.cast("bigint"))}
        assert [r["Mart"] for r in rank_checks(spoilt).filter("NOT Passed").collect()] == ["product"]


def test_rank_has_no_window_and_keeps_column_names(spark):
    from tillroll.operators.ranking import SortKey, rank_rows

    df = spark.range(100).select("id", F.lit("x").alias("range"), F.lit("y").alias("place"), F.lit("z").alias("before"))
    out = rank_rows(df, [SortKey("id", descending=True)], "of_range", ranges=7)
    assert out.columns == ["id", "range", "place", "before", "of_range"]
    assert {r["id"]: r["of_range"] for r in out.collect()} == {i: 100 - i for i in range(100)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "hashpartitioning" not in plan


# --- moments ---------------------------------------------------------------------------

def test_moments_are_the_same_on_any_partitioning(spark):
    rnd = random.Random(9)
    values = [Decimal(rnd.randrange(-10**9, 10**9)) / 10_000 for _ in range(5000)] + [Decimal("99999999.9999"), None]
    df = spark.createDataFrame([(v, None if v is None else int(v)) for v in values], "Price decimal(14,4), Quantity int")
    rows = {n: sorted(map(tuple, column_stats(df.repartition(n), ["Price", "Quantity"]).collect())) for n in (1, 200)}
    assert rows[1] == rows[200]
    known = [v for v in values if v is not None]
    n, total, squares = len(known), sum(known), sum(v * v for v in known)
    price = rows[1][0]
    assert price[1] == n and price[2] == (total / n).quantize(Decimal("0.0001"))
    exact = math.sqrt((n * squares - total * total) / (n * (n - 1)))
    assert abs(float(price[3]) - exact) < 1e-4


def test_moments_keep_digits_that_doubles_lose(spark):
    """A deviation of 1 around 10^10: double sums of squares lose it."""
    df = spark.range(1000).select((F.lit(10_000_000_000) + F.col("id") % 2 * 2).cast("bigint").alias("Quantity"))
    row = column_stats(df, ["Quantity"]).first()
    assert row["Mean"] == Decimal("10000000001.0000") and abs(float(row["StdDev"]) - math.sqrt(1000 / 999)) < 1e-4


def test_moments_of_no_and_one_value(spark):
    df = spark.createDataFrame([(1,)], "Quantity int")
    one, none = column_stats(df, ["Quantity"]).first(), column_stats(df.limit(0), ["Quantity"]).first()
    assert (one["NonNullCount"], one["Mean"], one["StdDev"]) == (1, Decimal("1.0000"), None)
    assert (none["NonNullCount"], none["Mean"], none["StdDev"]) == (0, None, None)
    with pytest.raises(TypeError):
        column_stats(df.select(F.col("Quantity").cast("double")), ["Quantity"])
