"""Gold: the line-level base and the four marts.

Plan shape, with scale in mind:

* ``invoice_grain`` sums the line metrics per (SaleDate, Country,
  Invoice, Customer ID). Partial aggregation runs map-side, so one
  shuffle of about one row per line-group per task moves the data, and a
  hot invoice, customer or country is pre-combined in every map task.
  The daily, customer and country marts all re-aggregate this much
  smaller table; their distinct counts (Orders, Customers) are exact
  because the set of invoices and customers per group is unchanged.
* The product mart needs StockCode, so it aggregates the lines itself, to
  (StockCode, Invoice) and from there to the product; its descriptions go
  apart, so that the lines are hashed and not sorted.
* Sums of money over many rows are taken as pairs of longs (``piece_sums``).
* Ranks go through ``rank_rows`` (range-partitioned);
  top-k reports use a distributed top-k instead of ranking every row.
* Year, Month and MonthName are functions of SaleDate: the daily mart
  groups by (SaleDate, Country) only and derives them afterwards.
* Ranks are computed on the unrounded NetRevenue and only then are the
  money columns rounded to 2 places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.constants import MONTH_NAME_FORMAT, TOP_K
from tillroll.functions.measures import (
    average_order_value,
    calendar_columns,
    PIECE_COLUMNS,
    line_metrics,
    net_revenue,
    piece_sums,
    return_rate,
    round_money,
    sums_of_pieces,
    transaction_class,
    with_line_pieces,
    with_sum_pieces,
)
from tillroll.operators.ranking import rank_global, rank_rows, revenue_order
from tillroll.schemas import (
    COUNTRY_COLUMNS,
    CUSTOMER_COLUMNS,
    CUSTOMER_ID,
    DAILY_COLUMNS,
    MONEY_COLUMNS,
    PRODUCT_COLUMNS,
)
from tillroll.session import materialize

CID = f"`{CUSTOMER_ID}`"


def gold_base(silver: DataFrame) -> DataFrame:
    """Silver + calendar columns + per-line metrics + TransactionClass."""
    return (
        silver.withColumns(calendar_columns("InvoiceDate"))
        .withColumns(line_metrics())
        .withColumn("TransactionClass", transaction_class())
    )


def invoice_grain(silver: DataFrame) -> DataFrame:
    """Line metrics summed per (SaleDate, Country, Invoice, Customer ID)."""
    lines = with_line_pieces(silver).select(
        F.to_date("InvoiceDate").alias("SaleDate"), "Country", "Invoice", F.col(CID), *PIECE_COLUMNS)
    return lines.groupBy("SaleDate", "Country", "Invoice", CUSTOMER_ID).agg(*sums_of_pieces())


PUBLISHED_COLUMNS = {
    "daily": DAILY_COLUMNS, "product": PRODUCT_COLUMNS, "customer": CUSTOMER_COLUMNS, "country": COUNTRY_COLUMNS,
}


def publish(df: DataFrame, mart: str) -> DataFrame:
    """An unrounded mart with its money rounded, in the published order."""
    return _round(df, PUBLISHED_COLUMNS[mart])


def _round(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: round_money(c) for c in MONEY_COLUMNS}).select(
        *[F.col(f"`{c}`") for c in columns]
    )


def daily_sales(silver: DataFrame, *, grain: DataFrame | None = None,
                rounded: bool = True) -> DataFrame:
    g = with_sum_pieces(grain if grain is not None else invoice_grain(silver))
    agg = g.groupBy("SaleDate", "Country").agg(
        F.countDistinct("Invoice").cast(T.LongType()).alias("Orders"),
        F.countDistinct(F.col(CID)).cast(T.LongType()).alias("Customers"),
        *sums_of_pieces("UnitsSold"),
    )
    mart = agg.withColumns(
        {
            "NetRevenue": net_revenue(),
            "Year": F.year("SaleDate").cast(T.IntegerType()),
            "Month": F.month("SaleDate").cast(T.IntegerType()),
            "MonthName": F.date_format("SaleDate", MONTH_NAME_FORMAT),
        }
    )
    if rounded:
        return _round(mart, DAILY_COLUMNS)
    return mart.select(*DAILY_COLUMNS)


def product_unranked(silver: DataFrame) -> DataFrame:
    """Product measures before rank and rounding.

    Description: the smallest non-empty description, else '' if only
    blank ones exist, else null; deterministic unlike "first".
    """
    # One shuffle of the size of the lines: the sums per (StockCode, Invoice),
    # combined map-side, so a hot product is spread over its invoices; a
    # product then counts its rows, without a distinct. The least of a text
    # cannot be kept in a hash table and would sort all lines: descriptions
    # go apart, each once per product before the least is taken, and meet the
    # sums by StockCode (Silver has no line without one).
    lines = with_line_pieces(silver).select("StockCode", "Invoice", *PIECE_COLUMNS)
    grain = lines.groupBy("StockCode", "Invoice").agg(*piece_sums())
    sums = grain.groupBy("StockCode").agg(
        F.count("Invoice").cast(T.LongType()).alias("Orders"), *sums_of_pieces("UnitsSold"))
    text = F.col("Description")
    # (a plain distinct would be optimised away before a least value)
    once = silver.groupBy("StockCode", "Description").agg(F.count(F.lit(1)).alias("_lines")).filter("_lines > 0")
    texts = once.groupBy("StockCode").agg(
        F.coalesce(F.min(F.nullif(text, F.lit(""))), F.min(text)).alias("Description"))
    agg = sums.join(texts, "StockCode", "left").select(
        "StockCode", "Orders", "Description", *[c for c in sums.columns if c not in ("StockCode", "Orders")])
    return agg.withColumns(
        {"NetRevenue": net_revenue(), "ReturnRate": return_rate("ReturnUnits", "UnitsSold")}
    )


def product_performance(silver: DataFrame, *, rounded: bool = True,
                        ranges: int | None = None) -> DataFrame:
    ranked = rank_rows(product_unranked(silver), revenue_order("StockCode"), "RevenueRank", ranges=ranges)
    if rounded:
        return _round(ranked, PRODUCT_COLUMNS)
    return ranked.select(*PRODUCT_COLUMNS)


def customer_unranked(silver: DataFrame, *, grain: DataFrame | None = None,
                      shared_plan: bool = False) -> DataFrame:
    """Customer measures before rank and rounding (lines with a customer).

    The customer filter comes first: it reaches the scan of Silver or of a
    written ``grain``. Only where the grain is part of one plan with other
    marts (``shared_plan``) does it follow the aggregate, on the count of
    customer ids, so that the plan has one shuffle for all of them.
    """
    measures = [
        F.countDistinct("Invoice").cast(T.LongType()).alias("Orders"),
        *sums_of_pieces("UnitsPurchased"),
    ]
    g = with_sum_pieces(grain if grain is not None else invoice_grain(silver))
    if shared_plan:
        agg = (
            g.groupBy(CUSTOMER_ID, "Country")
            .agg(*measures, F.count(F.col(CID)).alias("_ids"))
            .filter(F.col("_ids") > 0)
            .drop("_ids")
        )
    else:
        agg = g.filter(F.col(CID).isNotNull()).groupBy(CUSTOMER_ID, "Country").agg(*measures)
    return agg.withColumns(
        {"NetRevenue": net_revenue(), "AverageOrderValue": average_order_value("GrossSales", "Orders")}
    )


def customer_mart(silver: DataFrame, *, grain: DataFrame | None = None,
                  rounded: bool = True, ranges: int | None = None) -> DataFrame:
    ranked = rank_rows(
        customer_unranked(silver, grain=grain),
        revenue_order(CUSTOMER_ID, "Country"),
        "CustomerRank",
        ranges=ranges,
    )
    if rounded:
        return _round(ranked, CUSTOMER_COLUMNS)
    return ranked.select(*[F.col(f"`{c}`") for c in CUSTOMER_COLUMNS])


def country_unranked(silver: DataFrame, *, grain: DataFrame | None = None) -> DataFrame:
    g = with_sum_pieces(grain if grain is not None else invoice_grain(silver))
    agg = g.groupBy("Country").agg(
        F.countDistinct("Invoice").cast(T.LongType()).alias("Orders"),
        F.countDistinct(F.col(CID)).cast(T.LongType()).alias("Customers"),
        *sums_of_pieces("UnitsSold"),
    )
    return agg.withColumn("NetRevenue", net_revenue())


def country_sales(silver: DataFrame, *, grain: DataFrame | None = None,
                  rounded: bool = True) -> DataFrame:
    """Country mart. Country is free text, so its number is not bounded and
    the rank is a distributed one."""
    ranked = rank_rows(country_unranked(silver, grain=grain), revenue_order("Country"), "CountryRank")
    if rounded:
        return _round(ranked, COUNTRY_COLUMNS)
    return ranked.select(*COUNTRY_COLUMNS)


def top_ranked(mart: DataFrame, rank_col: str, k: int = TOP_K) -> DataFrame:
    """The k best-ranked rows of an already ranked mart (e.g. a written
    layer); the cut is the feature of the report."""
    return mart.filter(F.col(rank_col) <= k)


def _top_k(unranked: DataFrame, keys, rank_col: str, columns: list[str], k: int) -> DataFrame:
    """Rows ranked 1..k without ranking the rest: a distributed top-k
    (each task keeps its best k, then one merge of k-row lists), then
    row_number over those k rows. Same order, same ranks as the full
    rank."""
    best = unranked.orderBy(*[key.order() for key in keys]).limit(k)
    return _round(rank_global(best, keys, rank_col), columns)


def top_products(silver: DataFrame, k: int = TOP_K) -> DataFrame:
    return _top_k(product_unranked(silver), revenue_order("StockCode"), "RevenueRank",
                  PRODUCT_COLUMNS, k)


def top_customers(silver: DataFrame, k: int = TOP_K) -> DataFrame:
    return _top_k(customer_unranked(silver), revenue_order(CUSTOMER_ID, "Country"),
                  "CustomerRank", CUSTOMER_COLUMNS, k)


def top_countries(silver: DataFrame, k: int = TOP_K) -> DataFrame:
    return _top_k(country_unranked(silver), revenue_order("Country"), "CountryRank",
                  COUNTRY_COLUMNS, k)


def all_marts(silver: DataFrame, *, ranked: bool = True, rounded: bool = True) -> dict[str, DataFrame]:
    """The four marts over one Silver input.

    Daily, customer and country share one invoice-grain pre-aggregate.
    ``ranked=False`` returns the unranked, unrounded measures in one plan
    (Spark reuses the shared shuffles), which is what row counts, grain
    and reconciliation checks need; ranked marts are built from Silver and
    the grain written once to the shared checkpoint folder.
    """
    if not ranked:
        grain = invoice_grain(silver)
        return {
            "daily": daily_sales(silver, grain=grain, rounded=False),
            "product": product_unranked(silver),
            "customer": customer_unranked(silver, grain=grain, shared_plan=True),
            "country": country_unranked(silver, grain=grain),
        }
    # Each ranked mart runs its own jobs (materialize, rank), and shuffle
    # reuse does not cross jobs: write Silver and the grain once, as the
    # layer run does, so no job recomputes them.
    silver = materialize(silver, "silver")
    grain = materialize(invoice_grain(silver), "invoice-grain")
    return {
        "daily": daily_sales(silver, grain=grain, rounded=rounded),
        "product": product_performance(silver, rounded=rounded),
        "customer": customer_mart(silver, grain=grain, rounded=rounded),
        "country": country_sales(silver, grain=grain, rounded=rounded),
    }
