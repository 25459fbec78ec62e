"""Silver: dedup, clean, classify, quality rules and their reports.

Order matters and is kept: exact duplicates are removed on the raw
values *before* cleaning, so two lines that only become equal after
trim/upper both survive. The quality filter runs after cleaning.

Plan shape: the full-row dedup is one hash aggregate on all eight
columns (partial aggregation map-side, so even a row repeated a billion
times crosses the shuffle once per map task). The price and stock-code
predicates are pushed below that aggregate, the price one into the
Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.cleaning import (
    STOCK_CODE_PATTERN,
    clean_customer_id,
    clean_stock_code,
    clean_text,
    is_return,
    line_revenue,
    passes_price,
    passes_stock_code,
    reject_reason,
    transaction_type,
)
from tillroll.functions.measures import MONEY_SUMS, money_of_pieces, units_of_pieces, with_line_pieces
from tillroll.schemas import CUSTOMER_ID, RAW_COLUMNS, SILVER_COLUMNS


def _raw(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])


def dedup_lines(raw: DataFrame) -> DataFrame:
    """Drop exact duplicate lines (all eight raw columns equal)."""
    return _raw(raw).dropDuplicates()


def clean_lines(raw: DataFrame) -> DataFrame:
    """Deduplicated, cleaned lines with TransactionType, IsReturn and
    Revenue; the quality rules are not applied yet."""
    cleaned = dedup_lines(raw).select(
        clean_text("Invoice").alias("Invoice"),
        clean_stock_code("StockCode").alias("StockCode"),
        clean_text("Description").alias("Description"),
        "Quantity",
        "InvoiceDate",
        "Price",
        clean_customer_id(F.col(f"`{CUSTOMER_ID}`")).alias(CUSTOMER_ID),
        clean_text("Country").alias("Country"),
    )
    return cleaned.withColumns(
        {
            "TransactionType": transaction_type("Invoice"),
            "IsReturn": is_return("Quantity"),
            "Revenue": line_revenue("Quantity", "Price"),
        }
    )


def passes_quality() -> F.Column:
    """True/false (never null) per line: for counting and negating."""
    return passes_price("Price") & passes_stock_code("StockCode")


def quality_filter(clean: DataFrame) -> DataFrame:
    """Keep lines with Price > 0 and a stock code starting with five
    letters or digits.

    Written as plain comparisons (a null fails a filter anyway) so
    Catalyst can push the price bound into the Parquet scan.
    """
    return clean.filter((F.col("Price") > 0) & F.col("StockCode").rlike(STOCK_CODE_PATTERN))


def silver_lines(raw: DataFrame) -> DataFrame:
    """The Silver layer: 8 cleaned raw columns + 3 derived, filtered."""
    return quality_filter(clean_lines(raw)).select(*[F.col(f"`{c}`") for c in SILVER_COLUMNS])


KEPT = "_kept"


def judged_lines(clean: DataFrame) -> DataFrame:
    """Cleaned lines with the verdict of the quality rules (``_kept``) and
    their line pieces, each worked out once per line for all the metrics
    that are observed over them."""
    return with_line_pieces(clean.withColumn(KEPT, passes_quality()))


def quality_metrics(keep: F.Column | None = None) -> list[F.Column]:
    """The quality-report aggregates over cleaned lines (usable in
    ``agg`` or in ``observe`` during the Silver write). ``keep``: the
    verdict of the quality rules, if a column has it."""
    keep = passes_quality() if keep is None else keep
    return [
        F.count(F.lit(1)).alias("TotalRows"),
        F.count_if(F.col("Price") <= 0).alias("InvalidPriceRows"),
        F.count_if(F.col("Quantity") == 0).alias("ZeroQuantityRows"),
        F.count_if(F.col(f"`{CUSTOMER_ID}`").isNull()).alias("MissingCustomerRows"),
        F.count_if(F.col("Description").isNull()).alias("MissingDescriptionRows"),
        F.count_if(F.col("InvoiceDate").isNull()).alias("MissingDateRows"),
        F.count_if(keep).alias("KeptRows"),
        F.count_if(~keep).alias("RejectedRows"),
        F.count_if(keep & (F.col("Price") <= 0)).alias("RemainingInvalidPriceRows"),
    ]


def kept_totals_metrics() -> list[F.Column]:
    """Measure totals of the lines the quality filter keeps, for all of
    them and for those with a customer (the two scopes reconciliation
    compares against). Usable in ``observe`` on ``judged_lines`` during the
    Silver write, so validation need not scan Silver for them."""
    keep = F.col(KEPT)
    scopes = (("", keep), ("_c", keep & F.col(f"`{CUSTOMER_ID}`").isNotNull()))
    out = []
    for suffix, cond in scopes:
        out += [money_of_pieces(m, cond).alias(f"{m}{suffix}") for m in MONEY_SUMS]
        out += [units_of_pieces(m, cond).alias(f"{name}{suffix}")
                for name, m in (("UnitsSold", "SoldUnits"), ("ReturnUnits", "ReturnUnits"))]
    return out


def quality_report(clean: DataFrame) -> DataFrame:
    """One row over the cleaned lines, in a single scan.

    Issue counts (non-positive price, zero quantity, missing customer,
    description, date), rows rejected and kept by the quality filter, and
    the post-filter assertion that no kept row has Price <= 0.
    """
    return clean.agg(*quality_metrics())


def rejects_by_reason(clean: DataFrame) -> DataFrame:
    """Rows the quality filter drops, one count per reason."""
    return (
        clean.select(reject_reason().alias("RejectReason"))
        .filter(F.col("RejectReason").isNotNull())
        .groupBy("RejectReason")
        .agg(F.count(F.lit(1)).alias("RowCount"))
    )


def type_counts(clean: DataFrame) -> DataFrame:
    """Rows per TransactionType and per IsReturn, before and after the
    quality filter.

    One scan aggregates to the tiny (TransactionType, IsReturn) grid;
    the two breakdowns are re-aggregated from that grid.
    """
    grid = clean.groupBy("TransactionType", "IsReturn").agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count_if(passes_quality()).alias("n_after"),
    )
    unpivoted = grid.select(
        F.explode(
            F.array(
                F.struct(F.lit("TransactionType").alias("Breakdown"),
                         F.col("TransactionType").alias("Value")),
                F.struct(F.lit("IsReturn").alias("Breakdown"),
                         F.col("IsReturn").cast("string").alias("Value")),
            )
        ).alias("k"),
        "n_before",
        "n_after",
    )
    return unpivoted.groupBy(
        F.col("k.Breakdown").alias("Breakdown"), F.col("k.Value").alias("Value")
    ).agg(
        F.sum("n_before").cast("bigint").alias("RowsBeforeFilter"),
        F.sum("n_after").cast("bigint").alias("RowsAfterFilter"),
    )


def overlap_count(silver: DataFrame) -> DataFrame:
    """Cancelled lines with negative quantity (counted as cancelled, not
    as returns): informational."""
    return silver.agg(
        F.count_if(
            (F.col("TransactionType") == "Cancelled") & (F.col("Quantity") < 0)
        ).alias("CancelledNegativeRows")
    )
