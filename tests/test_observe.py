"""Observed counts (collected during writes) also arrive when AQE prunes
empty inputs, so no stage waits on a missing observation."""
from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.plans.medallion import LayerPaths, run_bronze, run_silver
from tillroll.schemas import RAW_SCHEMA
from tillroll.session import materialize_counted


def test_counts_after_empty_shuffle_and_empty_join(spark):
    agg = spark.range(1000).repartition(4).filter("id < 0").groupBy((F.col("id") % 3).alias("k")).count()
    assert materialize_counted(agg, "obs-agg")[1] == 0
    a = spark.range(100).withColumn("k", F.col("id") % 5)
    b = spark.range(100).filter("id > 1000").withColumn("k", F.col("id") % 5).withColumnRenamed("id", "id2")
    assert materialize_counted(a.join(b, "k"), "obs-join")[1] == 0


def test_layers_with_everything_rejected_or_empty(spark, scratch):
    ts = dt.datetime(2010, 1, 1)
    rows = [("1", "POST", "x", 1, ts, Decimal("1"), "1.0", "UK"),
            ("2", "22111", "y", 1, ts, Decimal("0"), "1.0", "UK")]
    paths = LayerPaths(os.path.join(scratch, "rejected"))
    assert run_bronze(spark, spark.createDataFrame(rows, RAW_SCHEMA), paths).first()["Passed"]
    rep = run_silver(spark, paths).first()
    assert (rep["TotalRows"], rep["KeptRows"], rep["RejectedRows"]) == (2, 0, 2)
    empty = LayerPaths(os.path.join(scratch, "empty"))
    check = run_bronze(spark, spark.createDataFrame([], RAW_SCHEMA), empty).first()
    assert (check["SourceRows"], check["TargetRows"], check["Passed"]) == (0, 0, True)
