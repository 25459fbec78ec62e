"""The join with hot keys: the same rows as a plain join, evenly spread."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators.enrich import with_part
from tillroll.operators.hot_join import hot_key_join, hot_keys

TASKS = 16


@pytest.fixture()
def plain_shuffles(spark):
    """No broadcast, no merging or splitting of partitions by AQE."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
              "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.shuffle.partitions": str(TASKS)}
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _fact(spark, n=40_000):
    """40 % of the rows have one key, 20 % none, the rest 3,000 keys."""
    i = F.col("id")
    key = F.when(i % 10 < 4, F.lit("hot")).when(i % 10 < 6, F.lit(None)).otherwise(F.concat(F.lit("k"), (i * 7919) % 3000))
    return spark.range(n).select(i, key.alias("StockCode"), F.lit(1).alias("piece"), F.lit(2).alias("hot"))


def _dimension(spark):
    keys = [("hot", "H"), ("absent", "A"), (None, "N")] + [(f"k{j}", f"v{j}") for j in range(0, 3000, 2)] + [("k4", "twice")]
    return spark.createDataFrame(keys, "PartCode string, Brand string")


def _rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_same_rows_as_a_plain_join(plain_shuffles, how):
    fact, dim = _fact(plain_shuffles, 4000), _dimension(plain_shuffles)
    got = hot_key_join(fact, dim, "StockCode", "PartCode", how=how)
    want = fact.join(dim, F.col("StockCode") == F.col("PartCode"), how).drop("PartCode")
    assert got.columns == want.columns and _rows(got) == _rows(want)


def test_hot_keys_are_fewer_than_tasks(plain_shuffles):
    found = {r["HotKey"]: r for r in hot_keys(_fact(plain_shuffles), "StockCode", TASKS).collect()}
    assert set(found) == {"hot", None} and found["hot"]["KeyRows"] == 16_000
    assert found["hot"]["Pieces"] == round(0.4 * TASKS * 8 + 0.49)


def test_largest_task_is_at_most_twice_the_median(plain_shuffles):
    fact, dim = _fact(plain_shuffles), _dimension(plain_shuffles)

    def sizes(df):
        # the count per partition reads the join where it is, without a further shuffle of its rows
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

    plain = sizes(fact.join(dim, F.col("StockCode") == F.col("PartCode"), "left"))
    cut = sizes(hot_key_join(fact, dim, "StockCode", "PartCode"))
    assert plain[-1] > 5 * plain[len(plain) // 2]
    assert len(cut) == TASKS and cut[-1] <= 2 * cut[len(cut) // 2]


def test_empty_sides(spark):
    fact, dim = _fact(spark, 500), _dimension(spark)
    assert hot_key_join(fact.limit(0), dim, "StockCode", "PartCode").count() == 0
    assert hot_key_join(fact, dim.limit(0), "StockCode", "PartCode").count() == 500
    with pytest.raises(ValueError):
        hot_key_join(fact, dim, "StockCode", "PartCode", how="full")


def test_lines_keep_their_number(spark, raw_lines):
    from tillroll.operators.silver import silver_lines

    lines = silver_lines(raw_lines)
    parts = spark.createDataFrame([("85048", "B1")], "PartCode string, Brand string")
    out = with_part(lines, parts)
    assert out.count() == lines.count()
    assert {r["StockCode"] for r in out.filter("Brand = 'B1'").collect()} == {"85048"}
