"""Money sums as pairs of longs, and what the layered run keeps off its
large tables: no sort of the lines, no aggregate and no check run twice."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.functions.measures import money_of_pieces, piece_sums, with_line_pieces, with_sum_pieces
from tillroll.operators import marts, silver
from tillroll.sources.fingerprints import fingerprint

EXTREMES = ["0.0001", "0.3", "9999.9999", "10000.0000", "9999999999.9999", "10000000000.0000", "123456789012345678.1234",
            "999999999999999999.9999"]


def _lines(spark, amounts):
    rows = [(Decimal(a), 1 if not a.startswith("-") else -1, "Normal") for a in amounts]
    return spark.createDataFrame(rows, "Revenue decimal(22,4), Quantity int, TransactionType string")


def test_sums_of_pieces_are_exact(spark):
    rng = random.Random(7)
    drawn = [f"{rng.randrange(10 ** rng.randrange(1, 19))}.{rng.randrange(10_000):04d}" for _ in range(3000)]
    amounts = [*EXTREMES, *drawn, *[f"-{a}" for a in [*EXTREMES, *drawn[:500]]]]
    pieces = with_line_pieces(_lines(spark, amounts))
    sums = [money_of_pieces(m).alias(m) for m in ("GrossSales", "ReturnAmount")]
    want = (sum(Decimal(a) for a in amounts if a[0] != "-"), sum(-Decimal(a) for a in amounts if a[0] == "-"))
    assert tuple(pieces.agg(*sums).first()) == want
    parts = pieces.groupBy(F.spark_partition_id(), F.col("Quantity")).agg(*piece_sums())
    assert tuple(parts.agg(*sums).first()) == want
    grain = pieces.groupBy("Quantity").agg(
        *[F.sum(f"_{u}").alias(u) for u in ("SoldUnits", "ReturnUnits")],
        *[money_of_pieces(m).alias(m) for m in ("GrossSales", "ReturnAmount", "CancelledAmount")])
    assert tuple(with_sum_pieces(grain).agg(*sums).first()) == want


@pytest.mark.parametrize("amount", EXTREMES)
def test_one_amount_comes_back(spark, amount):
    one = with_line_pieces(_lines(spark, [amount])).agg(money_of_pieces("GrossSales")).first()[0]
    assert one == Decimal(amount)


def test_null_amounts_stay_null(spark):
    lines = spark.createDataFrame([(None, None, "Cancelled")], "Revenue decimal(22,4), Quantity int, TransactionType string")
    got = with_line_pieces(lines).agg(*[money_of_pieces(m).alias(m) for m in ("GrossSales", "CancelledAmount")]).first()
    assert tuple(got) == (Decimal(0), None)


def test_fingerprint_is_the_sum_of_the_hashes(spark):
    df = spark.range(2000).select("id", F.concat(F.lit("t"), "id").alias("t"))
    values = [v for c in ("id", "t") for v in (F.col(c).isNull(), F.col(c))]
    hashes = df.select(*[F.xxhash64(F.lit(s), *values).alias(f"h{s}") for s in (1, 2)]).collect()
    assert tuple(fingerprint(df).first()) == (2000, sum(r["h1"] for r in hashes), sum(r["h2"] for r in hashes))
    plan = fingerprint(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(xxhash64" not in plan  # no decimal per row


def test_lines_are_not_sorted_for_the_product_mart(spark, raw_lines):
    """Before, the least description sorted every line by its product."""
    plan = marts.product_unranked(silver.silver_lines(raw_lines))._jdf.queryExecution().executedPlan().toString()
    hashed = [ln for ln in plan.splitlines() if "HashAggregate(keys=[StockCode" in ln]
    assert any("Invoice" in ln.split("functions")[0] for ln in hashed)
    assert any("Description" in ln.split("functions")[0] for ln in hashed)
    assert not [ln for ln in plan.splitlines() if "SortAggregate" in ln and "Invoice" in ln]


def test_rank_input_is_made_once(spark):
    """Dealing by ranges reads its rows twice; what made them ran twice."""
    from tillroll.operators.ranking import SortKey, rank_rows

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(3000).mapInArrow(count, "id bigint")
    assert rank_rows(df, [SortKey("id")], "Rank").filter("Rank = id + 1").count() == 3000
    assert made.value == 3000


def test_scans_of_layers_for_checks_are_kept(spark, raw_csv_path, tmp_path):
    from tillroll.plans.medallion import LayerPaths, run_layers

    report, paths = {}, LayerPaths(str(tmp_path))
    run_layers(spark, raw_csv_path, paths.root, report=report)
    for name, rows in (("rows", 7), ("grain", 4)):
        files = report[name].inputFiles()
        assert report[name].count() == rows and files and all(f"_check_{name}" in f for f in files)
