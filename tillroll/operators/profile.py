"""Profiling of raw lines (the exploration step), folded into a few
single-scan aggregates instead of one full parse per question.

These read the raw lines as delivered: no trim, no dedup. The invoice
type uses the untrimmed invoice number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.cleaning import transaction_type
from tillroll.schemas import CUSTOMER_ID, RAW_COLUMNS

STAT_TYPE = T.DecimalType(18, 4)


def _c(name: str) -> F.Column:
    return F.col(f"`{name}`")


def null_counts(raw: DataFrame) -> DataFrame:
    """Nulls per raw column, one row, columns named as the raw ones."""
    return raw.agg(
        *[F.sum(_c(c).isNull().cast("int")).cast(T.LongType()).alias(c) for c in RAW_COLUMNS]
    )


def distinct_counts(raw: DataFrame) -> DataFrame:
    """Exact distinct counts of five columns in one aggregate (Catalyst
    expands the rows once per distinct column and pre-aggregates each)."""
    return raw.agg(
        F.countDistinct("Invoice").cast(T.LongType()).alias("DistinctInvoices"),
        F.countDistinct("StockCode").cast(T.LongType()).alias("DistinctProducts"),
        F.countDistinct("Description").cast(T.LongType()).alias("DistinctDescriptions"),
        F.countDistinct(_c(CUSTOMER_ID)).cast(T.LongType()).alias("DistinctCustomers"),
        F.countDistinct("Country").cast(T.LongType()).alias("DistinctCountries"),
    )


def date_range(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.min("InvoiceDate").alias("MinInvoiceDate"),
        F.max("InvoiceDate").alias("MaxInvoiceDate"),
    )


def duplicate_rows(raw: DataFrame) -> DataFrame:
    """Total rows, distinct rows and exact duplicates, in one shuffle."""
    groups = raw.groupBy(*[_c(c) for c in RAW_COLUMNS]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").cast(T.LongType()).alias("TotalRows"),
        F.count(F.lit(1)).cast(T.LongType()).alias("DistinctRows"),
    ).withColumn("DuplicateRows", F.col("TotalRows") - F.col("DistinctRows"))


def exact_moments(column: F.Column, scale: int) -> dict[str, F.Column]:
    """n, sum and sum of squares of a number with at most ``scale`` decimal
    places, in units of its last place, as exact decimals. Their value does
    not depend on the order of the rows, as that of double sums does. The
    squares of 10^13 values of 10^8 fit; larger sums raise an error."""
    units = (column.cast("decimal(38,8)") * F.lit(10**scale).cast("decimal(10,0)")).cast("decimal(18,0)")
    return {
        "n": F.count(column),
        "total": F.sum(units.cast("decimal(28,0)")).cast("decimal(38,0)"),
        "squares": F.sum((units * units).cast("decimal(28,0)")).cast("decimal(38,0)"),
    }


def _deviation(n: F.Column, total: F.Column, squares: F.Column, scale: int) -> F.Column:
    """Sample standard deviation from exact moments. With the whole part m
    and the rest r of total / n, the sum of squared deviations is
    squares - m (total + r) - r^2 / n; only that last step is a double."""
    wide = "decimal(38,0)"
    m = F.call_function("div", total, n.cast("decimal(20,0)")).cast("decimal(18,0)")
    r = total - (m * n.cast("decimal(20,0)")).cast(wide)
    whole = squares - (m * (total + r).cast(wide)).cast(wide)
    rest = r.cast("double") * r.cast("double") / n.cast("double")
    return F.when(n > 1, F.sqrt((whole.cast("double") - rest) / (n - 1).cast("double")) / F.lit(float(10**scale)))


def _mean(n: F.Column, total: F.Column, scale: int) -> F.Column:
    return F.when(n > 0, total.cast("decimal(28,0)") / n.cast("decimal(20,0)") / F.lit(10**scale).cast("decimal(10,0)"))


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """describe(): count, mean, sample stddev, min, max per column, one
    row per column, all in one scan. Figures are decimal(18,4), from exact
    sums: the same on any partitioning."""
    aggs = []
    for c in columns:
        col = _c(c)
        moments = exact_moments(col, _scale(df, c))
        aggs += [
            *[m.alias(f"{c}__{name}") for name, m in moments.items()],
            F.min(col).cast(STAT_TYPE).alias(f"{c}__min"),
            F.max(col).cast(STAT_TYPE).alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("ColumnName"),
                    F.col(f"{c}__n").cast(T.LongType()).alias("NonNullCount"),
                    _mean(F.col(f"{c}__n"), F.col(f"{c}__total"), _scale(df, c)).cast(STAT_TYPE).alias("Mean"),
                    _deviation(F.col(f"{c}__n"), F.col(f"{c}__total"), F.col(f"{c}__squares"), _scale(df, c))
                    .cast(STAT_TYPE).alias("StdDev"),
                    F.col(f"{c}__min").alias("MinValue"),
                    F.col(f"{c}__max").alias("MaxValue"),
                )
                for c in columns
            ]
        )
    ).alias("s")
    return wide.select(rows).select("s.*")


def _scale(df: DataFrame, column: str) -> int:
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return kind.scale
    if isinstance(kind, T.IntegralType):
        return 0
    raise TypeError(f"{column} is {kind.simpleString()}: exact moments need an integer or a decimal")


def price_quality_counts(raw: DataFrame) -> DataFrame:
    p = F.col("Price")
    return raw.agg(
        F.count_if(p == 0).alias("ZeroPriceRows"),
        F.count_if(p < 0).alias("NegativePriceRows"),
        F.count_if(p <= 0).alias("InvalidPriceRows"),
    )


def cancelled_rows(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count_if(F.col("Invoice").startswith("C")).alias("CancelledRows"))


def negative_quantity_rows(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count_if(F.col("Quantity") < 0).alias("NegativeQuantityRows"))


def rows_by_country(raw: DataFrame) -> DataFrame:
    """All countries by row count, largest first (ties by name)."""
    return (
        raw.groupBy("Country")
        .agg(F.count(F.lit(1)).alias("RowCount"))
        .orderBy(F.col("RowCount").desc(), F.col("Country").asc_nulls_first())
    )


def rows_by_invoice_type(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy(transaction_type("Invoice").alias("InvoiceType"))
        .agg(F.count(F.lit(1)).alias("RowCount"))
        .orderBy(F.col("RowCount").desc(), "InvoiceType")
    )


def raw_overview(raw: DataFrame) -> DataFrame:
    """Row count, nulls per column, date range, price and quantity issues
    and cancelled rows: six exploration questions in one scan."""
    p, q = F.col("Price"), F.col("Quantity")
    return raw.agg(
        F.count(F.lit(1)).alias("TotalRows"),
        *[F.count_if(_c(c).isNull()).alias(f"Null{c.replace(' ', '')}") for c in RAW_COLUMNS],
        F.min("InvoiceDate").alias("MinInvoiceDate"),
        F.max("InvoiceDate").alias("MaxInvoiceDate"),
        F.count_if(p == 0).alias("ZeroPriceRows"),
        F.count_if(p < 0).alias("NegativePriceRows"),
        F.count_if(q < 0).alias("NegativeQuantityRows"),
        F.count_if(q == 0).alias("ZeroQuantityRows"),
        F.min(q).alias("MinQuantity"),
        F.max(q).alias("MaxQuantity"),
        F.count_if(F.col("Invoice").startswith("C")).alias("CancelledRows"),
    )
