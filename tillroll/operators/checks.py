"""Validation: reconciliation, grain, null keys, negative revenue, ranks,
row counts. Every check is a small DataFrame of rows; only the gate
collects, and what it collects is the failed check rows.

Marts are passed as a dict ``{"daily", "product", "customer",
"country"}``; they can be freshly built DataFrames or written layers.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.measures import line_metrics, round_money
from tillroll.schemas import CUSTOMER_ID, MONEY_COLUMNS, SUM_TYPE
from tillroll.session import materialize
from tillroll.sources.layers import read_layer, write_layer

MART_NAMES = ("daily", "product", "customer", "country")
METRICS = ("GrossSales", "ReturnAmount", "CancelledAmount", "UnitsSold", "ReturnUnits", "NetRevenue")
GRAIN = {
    "daily": ["SaleDate", "Country"],
    "product": ["StockCode"],
    "customer": [CUSTOMER_ID, "Country"],
    "country": ["Country"],
}
KEY = {"product": "StockCode", "customer": CUSTOMER_ID, "country": "Country"}
RANK = {"product": "RevenueRank", "customer": "CustomerRank", "country": "CountryRank"}
UNITS = {"daily": "UnitsSold", "product": "UnitsSold", "customer": "UnitsPurchased", "country": "UnitsSold"}


# four published values of a row, each rounded by at most half a cent
NET_ROUNDING = Decimal("0.02")


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _long(row: DataFrame, pairs: list[tuple[str, str, str]]) -> DataFrame:
    """One-row frame -> rows (Mart, Metric, Value) for (mart, metric, column)."""
    return row.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("Mart"),
                        F.lit(k).alias("Metric"),
                        F.coalesce(_c(col).cast(SUM_TYPE), F.lit(0).cast(SUM_TYPE)).alias("Value"),
                    )
                    for m, k, col in pairs
                ]
            )
        ).alias("r")
    ).select("r.*")


def _metric_sums(units: str, suffix: str = "", where: Column | None = None) -> list[Column]:
    def s(c: str) -> Column:
        v = _c(c)
        return F.sum(v if where is None else F.when(where, v))

    return [
        s("GrossSales").alias(f"GrossSales{suffix}"),
        s("ReturnAmount").alias(f"ReturnAmount{suffix}"),
        s("CancelledAmount").alias(f"CancelledAmount{suffix}"),
        s(units).alias(f"UnitsSold{suffix}"),
        s("ReturnUnits").alias(f"ReturnUnits{suffix}"),
    ]


def mart_stats(mart: str, df: DataFrame) -> DataFrame:
    """Every scalar a check needs from one mart, in one aggregate: row
    count, measure totals, null keys, rank range, rows with negative
    published revenue; and the number of different ranks, from the rank
    column alone. The checks below select what they need from it (Catalyst
    prunes the other aggregates). Given
    ``stats_table`` output instead, they read that tiny table and do not
    scan the marts at all."""
    parts = F.col("GrossSales") - F.col("ReturnAmount") - F.col("CancelledAmount")
    aggs = [
        F.count(F.lit(1)).cast(T.LongType()).alias("RowCount"),
        *_metric_sums(UNITS[mart]),
        F.sum("NetRevenue").alias("NetColumn"),
        F.count_if(F.abs(F.col("NetRevenue") - parts) > NET_ROUNDING).cast(T.LongType()).alias("NetMismatch"),
    ]
    if mart in KEY:
        aggs.append(F.count_if(_c(KEY[mart]).isNull()).cast(T.LongType()).alias("NullKeys"))
        aggs.append(F.count_if(round_money("NetRevenue") < 0).cast(T.LongType()).alias("NegativeRows"))
    ranked = mart in RANK and RANK[mart] in df.columns
    if ranked:
        r = F.col(RANK[mart])
        aggs += [F.min(r).alias("MinRank"), F.max(r).alias("MaxRank")]
    row = _with_net(df.agg(*aggs))
    return row.withColumn("DistinctRanks", distinct_ranks(df, RANK[mart]).scalar()) if ranked else row


def distinct_ranks(df: DataFrame, rank_col: str) -> DataFrame:
    """How many different ranks occur, as one row (DistinctRanks), from
    bitmaps: each stretch of 32,768 ranks is a 4 KB bitmap, filled map-side
    and merged by stretch, so the ranks themselves do not travel. With the
    least rank 1 and the largest equal to the number of rows, as many
    different ranks as rows prove a permutation."""
    r = F.col(rank_col)
    stretches = df.groupBy(F.bitmap_bucket_number(r).alias("stretch")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(r)).alias("bits"))
    return stretches.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("DistinctRanks"))


def stats_table(marts: dict[str, DataFrame], path: str | None = None) -> dict[str, DataFrame]:
    """``mart_stats`` of every mart written once as one tiny table (one
    job; at ``path`` or in the scratch folder), then read back per mart.
    Checks given these stats do not scan the marts again."""
    rows = [mart_stats(m, df).withColumn("Mart", F.lit(m)) for m, df in marts.items()]
    all_rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    if path is None:
        table = materialize(all_rows, "mart-stats")
    else:
        write_layer(all_rows, path)
        table = read_layer(all_rows.sparkSession, path)
    return {m: table.filter(F.col("Mart") == m).drop("Mart") for m in marts}


def _stats(m: str, marts: dict[str, DataFrame], stats: dict[str, DataFrame] | None) -> DataFrame:
    return stats[m] if stats is not None else mart_stats(m, marts[m])


def _with_net(df: DataFrame, suffix: str = "") -> DataFrame:
    return df.withColumn(
        f"NetRevenue{suffix}",
        F.coalesce(_c(f"GrossSales{suffix}"), F.lit(0))
        - F.coalesce(_c(f"ReturnAmount{suffix}"), F.lit(0))
        - F.coalesce(_c(f"CancelledAmount{suffix}"), F.lit(0)),
    )


def reconciliation(silver: DataFrame, marts: dict[str, DataFrame],
                   stats: dict[str, DataFrame] | None = None,
                   source_totals: DataFrame | None = None) -> DataFrame:
    """Silver totals against each mart's totals, exact.

    The customer mart is compared with Silver lines that have a customer.
    Pass unrounded marts for an exact (zero-difference) reconciliation;
    any subset of the four marts may be given. One scan of Silver
    computes both source scopes, unless ``source_totals`` (the one-row
    totals observed while Silver was written) is given.
    """
    names = [m for m in MART_NAMES if m in marts]
    if source_totals is not None:
        src = source_totals
    else:
        lines = silver.select(_c(CUSTOMER_ID), *[e.alias(n) for n, e in line_metrics().items()])
        has_customer = _c(CUSTOMER_ID).isNotNull()
        src = lines.agg(
            *_metric_sums("SoldUnits"),
            *_metric_sums("SoldUnits", "_c", has_customer),
        )
    src = _with_net(_with_net(src), "_c")
    source = _long(
        src,
        [(m, k, f"{k}_c" if m == "customer" else k) for m in names for k in METRICS],
    ).withColumn("Side", F.lit("source"))
    gold = _union(
        [
            _long(_stats(m, marts, stats), [(m, k, k) for k in METRICS])
            for m in names
        ]
    ).withColumn("Side", F.lit("gold"))
    both = source.unionByName(gold)
    return (
        both.groupBy("Mart", "Metric")
        .agg(
            F.max(F.when(F.col("Side") == "source", F.col("Value"))).alias("SourceValue"),
            F.max(F.when(F.col("Side") == "gold", F.col("Value"))).alias("GoldValue"),
        )
        .withColumn("Difference", (F.col("SourceValue") - F.col("GoldValue")).cast(SUM_TYPE))
        .withColumn("Passed", F.col("Difference") == 0)
    )


def totals_metrics(mart: str) -> list[Column]:
    """Aggregates over an unrounded mart, to observe while it is written:
    its exact totals, and those of its published (rounded) columns."""
    columns = {m: UNITS[mart] if m == "UnitsSold" else m for m in METRICS}
    exact = [F.sum(_c(c)).cast(SUM_TYPE).alias(m) for m, c in columns.items()]
    published = [
        F.sum(round_money(c) if c in MONEY_COLUMNS else _c(c)).cast(SUM_TYPE).alias(f"{m}_published")
        for m, c in columns.items()
    ]
    return [*exact, *published]


def _totals_of(totals: DataFrame, mart: str) -> DataFrame:
    return totals.filter(F.col("Mart") == mart)


def gate_rows(silver: DataFrame, totals: DataFrame, source_totals: DataFrame | None = None) -> DataFrame:
    """The blocking reconciliation of all four marts with Silver: exact
    totals, no difference allowed. ``totals``: one row per mart with the
    ``totals_metrics`` observed while it was written."""
    names = dict.fromkeys(MART_NAMES)
    return reconciliation(silver, names, {m: _totals_of(totals, m) for m in names}, source_totals)


def published_checks(stats: dict[str, DataFrame], totals: DataFrame) -> DataFrame:
    """The written marts against what was published: the sums of their
    columns, and no row whose NetRevenue is not that of its parts."""
    frames = []
    for m in MART_NAMES:
        have = _long(stats[m], [(m, k, "NetColumn" if k == "NetRevenue" else k) for k in METRICS]
                     + [(m, "NetMismatch", "NetMismatch")])
        want = _long(_totals_of(totals, m).withColumn("NetMismatch", F.lit(0)),
                     [(m, k, f"{k}_published") for k in METRICS] + [(m, "NetMismatch", "NetMismatch")])
        frames.append(want.withColumnRenamed("Value", "Published").join(
            have.withColumnRenamed("Value", "Written"), ["Mart", "Metric"]))
    return _union(frames).withColumn("Passed", F.col("Published") == F.col("Written"))


def grain_checks(marts: dict[str, DataFrame]) -> DataFrame:
    """Keys with more than one row, per mart (all four, daily included)."""
    frames = []
    for m in MART_NAMES:
        keyed = marts[m].groupBy(*[_c(k) for k in GRAIN[m]]).agg(F.count(F.lit(1)).alias("_n"))
        frames.append(
            keyed.agg(F.count_if(F.col("_n") > 1).cast(T.LongType()).alias("DuplicateKeys"))
            .select(F.lit(m).alias("Mart"), "DuplicateKeys")
        )
    return _union(frames).withColumn("Passed", F.col("DuplicateKeys") == 0)


def null_key_checks(marts: dict[str, DataFrame],
                    stats: dict[str, DataFrame] | None = None) -> DataFrame:
    frames = [
        _stats(m, marts, stats).select(F.lit(m).alias("Mart"), F.lit(KEY[m]).alias("KeyColumn"), "NullKeys")
        for m in ("product", "country", "customer")
    ]
    return _union(frames).withColumn("Passed", F.col("NullKeys") == 0)


def negative_net(marts: dict[str, DataFrame],
                 stats: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows whose published (2-place) NetRevenue is below zero.
    Informational: net losses are legitimate."""
    frames = [
        _stats(m, marts, stats).select(F.lit(m).alias("Mart"), "NegativeRows")
        for m in ("product", "customer", "country")
    ]
    return _union(frames)


def rank_checks(marts: dict[str, DataFrame],
                stats: dict[str, DataFrame] | None = None) -> DataFrame:
    """A rank column must be a permutation of 1..rows."""
    frames = [
        _stats(m, marts, stats).select(
            F.lit(m).alias("Mart"), "RowCount", "MinRank", "MaxRank", "DistinctRanks"
        )
        for m in ("product", "customer", "country")
    ]
    rc = F.col("RowCount")
    return _union(frames).withColumn(
        "Passed",
        (rc == 0)
        | ((F.col("MinRank") == 1) & (F.col("MaxRank") == rc) & (F.col("DistinctRanks") == rc)),
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            df.agg(F.count(F.lit(1)).cast(T.LongType()).alias("RowCount")).select(
                F.lit(name).alias("Layer"), "RowCount"
            )
            for name, df in layers.items()
        ]
    )


class ValidationError(RuntimeError):
    pass


def enforce(checks: DataFrame, what: str) -> None:
    """Raise if any blocking check row failed (collects only failures)."""
    failed = checks.filter(~F.coalesce(F.col("Passed"), F.lit(False))).collect()
    if failed:
        raise ValidationError(f"{what} failed: {[r.asDict() for r in failed]}")
