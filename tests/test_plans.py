"""Plan-shape tests: pushdown, pruning, partition pruning, shuffle count."""
from __future__ import annotations

import os

from pyspark.sql import functions as F

from tillroll.operators import marts, silver
from tillroll.plans.medallion import LayerPaths, run_layers
from tillroll.sources.layers import read_layer, write_layer


def _plan(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_price_filter_reaches_parquet_scan(spark, raw_lines, scratch):
    path = os.path.join(scratch, "bronze")
    write_layer(raw_lines, path)
    s = silver.silver_lines(read_layer(spark, path))
    plan = _plan(s)
    assert "PushedFilters: [IsNotNull(Price), GreaterThan(Price,0.0000)]" in plan
    # the stock-code rule is evaluated below the dedup aggregate
    tree = plan.split("\n\n")[0]
    lines = tree.splitlines()
    filter_at = max(i for i, ln in enumerate(lines) if "Filter" in ln)
    agg_at = max(i for i, ln in enumerate(lines) if "HashAggregate" in ln)
    assert filter_at > agg_at
    assert "RLIKE" in plan.split("Filter", 2)[2] or "rlike" in plan.lower()


def test_column_pruning_for_country_mart(spark, raw_lines, scratch):
    path = os.path.join(scratch, "silver")
    write_layer(silver.silver_lines(raw_lines), path)
    country = marts.country_unranked(read_layer(spark, path))
    plan = _plan(country)
    read_schema = plan[plan.index("ReadSchema:"):].split("\n")[0]
    for unused in ("Description", "StockCode", "Price", "IsReturn"):
        assert unused not in read_schema


def test_daily_layout_prunes_partitions(spark, raw_lines, scratch):
    path = os.path.join(scratch, "daily")
    daily = marts.daily_sales(silver.silver_lines(raw_lines))
    write_layer(daily, path, partition_by=["Year", "Month"])
    one_year = read_layer(spark, path).filter(F.col("Year") == 2009)
    plan = _plan(one_year)
    assert "PartitionFilters: [isnotnull(Year" in plan and "(Year#" in plan
    assert one_year.count() == daily.filter(F.col("Year") == 2009).count()


def test_shared_invoice_grain_is_one_shuffle_of_lines(spark, raw_lines):
    s = silver.silver_lines(raw_lines)
    grain = marts.invoice_grain(s)
    plan = _plan(grain)
    # one exchange for the dedup, one for the invoice grain
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 2


def test_run_layers_end_to_end(spark, raw_csv_path, scratch):
    out = os.path.join(scratch, "layers")
    counts = {r["Layer"]: r["RowCount"] for r in run_layers(spark, raw_csv_path, out).collect()}
    assert counts == {"bronze": 18, "silver": 12, "daily": 4, "product": 11,
                      "customer": 4, "country": 3}
    paths = LayerPaths(out)
    years = {r["Year"] for r in read_layer(spark, paths.mart("daily")).collect()}
    assert years == {2009, None}
    top = marts.top_ranked(read_layer(spark, paths.mart("product")), "RevenueRank")
    assert sorted(r["RevenueRank"] for r in top.collect()) == list(range(1, 11))


def test_silver_report_is_observed_during_write(spark, raw_csv_path, scratch):
    from tillroll.plans.medallion import run_bronze, run_silver

    paths = LayerPaths(os.path.join(scratch, "obs"))
    run_bronze(spark, raw_csv_path, paths)
    report = run_silver(spark, paths).first().asDict()
    assert report["TotalRows"] == 17 and report["KeptRows"] == 12 and report["RejectedRows"] == 5
    assert read_layer(spark, paths.silver).count() == 12
