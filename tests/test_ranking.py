from __future__ import annotations

import random
from decimal import Decimal

from tillroll.operators.ranking import SortKey, rank_global, rank_rows


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all rows share one revenue value; some nulls
        r = rnd.random()
        if r < 0.34:
            rev = Decimal("0.0000")
        elif r < 0.37:
            rev = None
        else:
            rev = Decimal(rnd.randint(-5000, 50000)) / 100
        key = None if i == 0 else f"K{rnd.randint(0, 10**6):07d}-{i}"
        rows.append((key, rev))
    return spark.createDataFrame(rows, "Key string, NetRevenue decimal(28,4)")


KEYS = [SortKey("NetRevenue", descending=True), SortKey("Key")]


def _ranks(df):
    return {(r["Key"], r["NetRevenue"]): r["Rank"] for r in df.collect()}


def test_ranges_equal_the_single_task_rank(spark):
    df = _data(spark)
    want = _ranks(rank_global(df, KEYS, "Rank"))
    for ranges in (1, 7, 40):
        assert _ranks(rank_rows(df, KEYS, "Rank", ranges=ranges)) == want
    assert sorted(want.values()) == list(range(1, 3001))


def test_default_ranges_empty_and_bigint(spark):
    df = _data(spark, n=500, seed=3)
    got = rank_rows(df, KEYS, "Rank")
    assert dict(got.dtypes)["Rank"] == "bigint"
    assert _ranks(got) == _ranks(rank_global(df, KEYS, "Rank"))
    assert rank_rows(df.limit(0), KEYS, "Rank").count() == 0


def test_heavy_tie_is_split_across_ranges(spark):
    """34% of the rows share NetRevenue 0; ranges are cut on the whole sort
    key, so the tie does not land in one of them."""
    from pyspark.sql import functions as F

    df = _data(spark).repartitionByRange(8, *[k.order() for k in KEYS])
    held = df.filter("NetRevenue = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(held) >= 3


def test_many_ranges_match_global_rank(spark):
    from pyspark.sql import functions as F

    n = 50_000
    df = spark.range(n).select(
        F.format_string("K%06d", (F.col("id") * 7919) % n).alias("Key"),
        ((F.col("id") % 700) - 200).cast("decimal(28,4)").alias("NetRevenue"),
        F.col("id"),
    )
    got = rank_rows(df, KEYS, "Rank", ranges=250)
    want = rank_global(df, KEYS, "Rank").select("id", F.col("Rank").alias("W"))
    assert got.join(want, "id").filter("Rank != W").count() == 0
    assert got.count() == n
