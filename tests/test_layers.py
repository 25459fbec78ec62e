from __future__ import annotations

import glob
import os

from tillroll.sources.layers import layer_profile, read_layer, row_count_check, write_layer
from tillroll.sources.raw import read_raw, write_raw_csv


def test_layer_profile(raw_lines):
    p = layer_profile(raw_lines).first()
    assert p["Rows"] == 18 and p["Columns"] == 8 and p["Partitions"] >= 1
    assert p["Schema"].startswith("struct<Invoice:string,")


def test_write_layer_codec_and_file_size(spark, raw_lines, scratch):
    path = os.path.join(scratch, "bronze")
    write_layer(raw_lines.coalesce(1), path, max_records_per_file=5)
    files = glob.glob(os.path.join(path, "*.parquet"))
    assert len(files) == 4  # 18 rows, at most 5 per file
    assert all(f.endswith(".snappy.parquet") for f in files)
    assert row_count_check(raw_lines, read_layer(spark, path), "bronze").first()["Passed"]


def test_row_count_check_fails_on_loss(spark, raw_lines, scratch):
    path = os.path.join(scratch, "lossy")
    write_layer(raw_lines.limit(10), path)
    row = row_count_check(raw_lines, read_layer(spark, path), "bronze").first()
    assert (row["SourceRows"], row["TargetRows"], row["Passed"]) == (18, 10, False)


def test_csv_round_trip_keeps_values(spark, raw_lines, scratch):
    path = os.path.join(scratch, "csv")
    write_raw_csv(raw_lines, path)
    back = read_raw(spark, path)
    key = ["Invoice", "StockCode", "Description", "Quantity", "Price"]
    a = sorted(tuple(r) for r in raw_lines.select(*key).collect())
    b = sorted(tuple(r) for r in back.select(*key).collect())
    assert a == b  # quoting, padding and whitespace-only text survive


def test_sample_rows(raw_lines):
    assert len(raw_lines.limit(5).collect()) == 5


def test_read_raw_with_other_date_format(spark, scratch):
    path = os.path.join(scratch, "us.csv")
    with open(path, "w") as f:
        f.write("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n")
        f.write("536365,85123A,HEART,6,12/1/2010 8:26,2.55,17850.0,United Kingdom\n")
    r = read_raw(spark, path, timestamp_format="M/d/yyyy H:mm").first()
    assert str(r["InvoiceDate"]) == "2010-12-01 08:26:00"


def test_validation_blocks_a_corrupted_mart(spark, raw_csv_path, scratch):
    import pytest
    from pyspark.sql import functions as F

    from tillroll.operators.checks import ValidationError
    from tillroll.plans.medallion import LayerPaths, run_layers, run_validation

    out = os.path.join(scratch, "gate")
    run_layers(spark, raw_csv_path, out).collect()
    paths = LayerPaths(out)

    def corrupt(mart, column, value):
        good = read_layer(spark, paths.mart(mart))
        rows, schema = good.collect(), good.schema
        bad = spark.createDataFrame(rows, schema).withColumn(column, value.cast(schema[column].dataType)).collect()
        write_layer(spark.createDataFrame(bad, schema), paths.mart(mart))
        with pytest.raises(ValidationError, match=mart):
            run_validation(spark, paths)
        write_layer(spark.createDataFrame(rows, schema), paths.mart(mart))

    corrupt("product", "UnitsSold", F.col("UnitsSold") + 1)
    corrupt("product", "NetRevenue", F.lit(7))
    corrupt("customer", "GrossSales", F.col("GrossSales") * 3)
    corrupt("daily", "UnitsSold", F.col("UnitsSold") + 1000)
    corrupt("country", "CancelledAmount", F.lit(0))
    run_validation(spark, paths)


def test_sums_of_rounded_rows_do_not_fail_validation(spark, scratch):
    """2,000 products sold once at 1.0049: every published figure is right,
    and their sum is 9.80 away from the exact one."""
    from pyspark.sql import functions as F

    from tillroll.plans.medallion import LayerPaths, read_marts, run_layers
    from tillroll.schemas import DAILY_COLUMNS

    lines = spark.range(2000).select(
        F.lit("1").alias("Invoice"), F.format_string("P%06d", "id").alias("StockCode"), F.lit("X").alias("Description"),
        F.lit(1).alias("Quantity"), F.lit("2009-12-01 07:45").alias("InvoiceDate"), F.lit("1.0049").alias("Price"),
        F.lit("7.0").alias("Customer ID"), F.lit("UK").alias("Country"))
    report = {}
    run_layers(spark, lines, os.path.join(scratch, "cents"), report=report).collect()
    assert {"bronze", "quality", "gate", "published", "grain", "ranks"} <= set(report)
    assert report["gate"].count() == 24
    assert read_marts(spark, LayerPaths(os.path.join(scratch, "cents")))["daily"].columns == DAILY_COLUMNS


def test_dates_in_all_default_forms(spark, scratch):
    path = os.path.join(scratch, "dates.csv")
    forms = ["2009-12-01 07:45:00", "2009-12-01 07:45", "2009-12-01", "2009-12-01T07:45:00", "2009-12-01 07:45:00.5"]
    with open(path, "w") as f:
        f.write("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n")
        f.writelines(f"1,85123A,HEART,6,{d},2.55,17850.0,UK\n" for d in forms)
    assert [str(r["InvoiceDate"])[:10] for r in read_raw(spark, path).collect()] == ["2009-12-01"] * 5


def test_rows_by_country_lists_every_country(spark):
    from pyspark.sql import functions as F

    from tillroll.operators.profile import rows_by_country

    raw = spark.range(400).select(F.format_string("C%03d", F.col("id") % 200).alias("Country"))
    assert rows_by_country(raw).count() == 200


def test_checks_from_stats_table_equal_direct_checks(spark, raw_lines):
    from tillroll.operators import checks, marts, silver

    s = silver.silver_lines(raw_lines)
    m = marts.all_marts(s)
    st = checks.stats_table(m)
    for fn in (checks.null_key_checks, checks.rank_checks, checks.negative_net):
        assert sorted(map(tuple, fn(m).collect())) == sorted(map(tuple, fn(m, st).collect()))
    rec = lambda x: sorted(map(tuple, x.collect()))
    assert rec(checks.reconciliation(s, m)) == rec(checks.reconciliation(s, m, st))


def test_gate_from_observed_totals_equals_gate_from_silver(spark, raw_csv_path, scratch):
    from tillroll.operators import checks
    from tillroll.plans.medallion import LayerPaths, read_marts, run_layers

    out = os.path.join(scratch, "totals")
    run_layers(spark, raw_csv_path, out).collect()
    paths = LayerPaths(out)
    s, m = read_layer(spark, paths.silver), read_marts(spark, paths)
    totals, written = read_layer(spark, paths.silver_totals), read_layer(spark, paths.mart_totals)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(checks.gate_rows(s, written, totals)) == rows(checks.gate_rows(s, written))
    assert rows(checks.reconciliation(s, m, source_totals=totals)) == rows(checks.reconciliation(s, m))


def test_read_raw_parquet_conforms_types(spark, scratch):
    from decimal import Decimal

    from tillroll.sources.raw import read_raw_parquet

    path = os.path.join(scratch, "rawpq")
    spark.createDataFrame(
        [("C1", "85048", "X", 2.0, "2009-12-01 07:45:00", 6.95, "1.0", "UK")],
        "Invoice string, StockCode string, Description string, Quantity double, "
        "InvoiceDate string, Price double, `Customer ID` string, Country string",
    ).write.parquet(path)
    r = read_raw_parquet(spark, path).first()
    assert (r["Quantity"], r["Price"], str(r["InvoiceDate"])) == (2, Decimal("6.9500"), "2009-12-01 07:45:00")


def test_cluster_conf_names_a_shared_checkpoint_folder():
    from tillroll.session import cluster_conf

    conf = cluster_conf(4000, "hdfs:///tmp/ckpt")
    assert conf["spark.checkpoint.dir"] == "hdfs:///tmp/ckpt"
    assert int(conf["spark.sql.shuffle.partitions"]) == 12000
    assert conf["spark.sql.adaptive.enabled"] == "true"
