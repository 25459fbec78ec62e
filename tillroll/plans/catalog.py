"""Registered queries: one per operator of the inventory, each reading the
whole test tables through the raw-lines view, with its SQL oracle.

``queries()`` maps a name to ``fn(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` maps the same names to DuckDB SQL over the test tables.
Column names and types agree on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.measures import line_metrics
from tillroll.operators import checks, distincts, enrich, marts, profile, silver
from tillroll.plans import oracle as O
from tillroll.plans.medallion import LayerPaths, run_bronze, run_layers, run_silver
from tillroll.schemas import DAILY_COLUMNS, RAW_COLUMNS
from tillroll.session import materialize, scratch_path
from tillroll.sources.layers import layer_profile, read_layer, write_checked, write_clustered, write_layer
from tillroll.sources.raw import read_raw, read_report, write_raw_csv
from tillroll.sources.testtables import dirty_lines, retail_lines

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail_lines(spark, sf_dir)


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_lines(raw_lines(spark, sf_dir))


def clean_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_lines(raw_lines(spark, sf_dir))


# --- raw view and Silver ---------------------------------------------------

register("retail_lines", O.with_ctes(O.CTE_RAW, "SELECT * FROM raw"))(raw_lines)


@register("clean_lines", O.with_ctes(O.CTE_CLEAN, "SELECT * FROM clean"))
def q_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_of(spark, sf_dir)


@register("silver_lines", O.with_ctes(O.CTE_SILVER, "SELECT * FROM silver"))
def q_silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_of(spark, sf_dir)


# --- Gold ------------------------------------------------------------------

@register("gold_base", O.with_ctes(O.CTE_BASE, "SELECT * FROM base"))
def q_gold_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.gold_base(silver_of(spark, sf_dir))


@register("daily_sales", O.with_ctes(O.CTE_DAILY, "SELECT * FROM daily"))
def q_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_sales(silver_of(spark, sf_dir))


@register("product_performance", O.with_ctes(O.CTE_PRODUCT, "SELECT * FROM product"))
def q_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.product_performance(silver_of(spark, sf_dir))


@register("customer_mart", O.with_ctes(O.CTE_CUSTOMER, "SELECT * FROM customer_m"))
def q_customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_mart(silver_of(spark, sf_dir))


@register("country_sales", O.with_ctes(O.CTE_COUNTRY, "SELECT * FROM country"))
def q_country_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.country_sales(silver_of(spark, sf_dir))


# More ranges than the session would use: a few dozen rows in each.
MANY_RANGES = 60


@register("customer_rank_distributed", O.with_ctes(O.CTE_CUSTOMER, "SELECT * FROM customer_m"))
def q_customer_rank_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_mart(silver_of(spark, sf_dir), ranges=MANY_RANGES)


@register("product_rank_distributed", O.with_ctes(O.CTE_PRODUCT, "SELECT * FROM product"))
def q_product_rank_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.product_performance(silver_of(spark, sf_dir), ranges=MANY_RANGES)


@register("invoice_grain", O.INVOICE_GRAIN)
def q_invoice_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.invoice_grain(silver_of(spark, sf_dir))


@register("top_products", O.TOP_PRODUCTS)
def q_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_products(silver_of(spark, sf_dir))


@register("top_customers", O.TOP_CUSTOMERS)
def q_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_customers(silver_of(spark, sf_dir))


@register("top_countries", O.TOP_COUNTRIES)
def q_top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_countries(silver_of(spark, sf_dir))


# --- profiling of raw lines ------------------------------------------------

def _raw_query(fn):
    return lambda spark, sf_dir: fn(raw_lines(spark, sf_dir))


register("null_counts", O.NULL_COUNTS)(_raw_query(profile.null_counts))
register("distinct_counts", O.DISTINCT_COUNTS)(_raw_query(profile.distinct_counts))
register("date_range", O.DATE_RANGE)(_raw_query(profile.date_range))
register("duplicate_rows", O.DUPLICATE_ROWS)(_raw_query(profile.duplicate_rows))
register("quantity_price_stats", O.QUANTITY_PRICE_STATS)(
    _raw_query(lambda raw: profile.column_stats(raw, ["Quantity", "Price"]))
)
register("price_quality_counts", O.PRICE_QUALITY_COUNTS)(_raw_query(profile.price_quality_counts))
register("cancelled_rows", O.CANCELLED_ROWS)(_raw_query(profile.cancelled_rows))
register("negative_quantity_rows", O.NEGATIVE_QUANTITY_ROWS)(
    _raw_query(profile.negative_quantity_rows)
)
register("raw_overview", O.RAW_OVERVIEW)(_raw_query(profile.raw_overview))
register("rows_by_country", O.ROWS_BY_COUNTRY)(_raw_query(profile.rows_by_country))
register("rows_by_invoice_type", O.ROWS_BY_INVOICE_TYPE)(_raw_query(profile.rows_by_invoice_type))


# --- Silver reports ----------------------------------------------------------

def _clean_query(fn):
    return lambda spark, sf_dir: fn(clean_of(spark, sf_dir))


register("silver_type_counts", O.SILVER_TYPE_COUNTS)(_clean_query(silver.type_counts))
register("quality_report", O.QUALITY_REPORT)(_clean_query(silver.quality_report))
register("rejects_by_reason", O.REJECTS_BY_REASON)(_clean_query(silver.rejects_by_reason))
register("clean_line_stats", O.CLEAN_LINE_STATS)(
    _clean_query(lambda clean: profile.column_stats(clean, ["Quantity", "Price", "Revenue"]))
)


@register("overlap_check", O.OVERLAP_CHECK)
def q_overlap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.overlap_count(silver_of(spark, sf_dir))


# --- validation ------------------------------------------------------------

@register("reconciliation", O.RECONCILIATION)
def q_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_of(spark, sf_dir)
    return checks.reconciliation(s, marts.all_marts(s, ranked=False))


def _validated(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All layers written, and the checks over the written marts."""
    report: dict[str, DataFrame] = {}
    run_layers(spark, raw_lines(spark, sf_dir), scratch_path(spark, "validated"), report=report)
    return report


@register("reconciliation_gate", O.RECONCILIATION)
def q_reconciliation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact reconciliation of all four marts over written layers."""
    return _validated(spark, sf_dir)["gate"]


@register("grain_checks", O.GRAIN_CHECKS)
def q_grain_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir)["grain"]


@register("null_key_checks", O.NULL_KEY_CHECKS)
def q_null_key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir)["null_keys"]


@register("negative_net", O.NEGATIVE_NET)
def q_negative_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.negative_net(marts.all_marts(silver_of(spark, sf_dir), ranked=False))


@register("rank_checks", O.RANK_CHECKS)
def q_rank_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.rank_checks(marts.all_marts(silver_of(spark, sf_dir)))


@register("layer_counts", O.LAYER_COUNTS)
def q_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_lines(spark, sf_dir)
    s = silver.silver_lines(raw)
    return checks.layer_counts({"raw": raw, "silver": s, **marts.all_marts(s, ranked=False)})


# --- dimension join, skew, layout, ingestion ----------------------------------

@register("country_region_sales", O.COUNTRY_REGION_SALES)
def q_country_region_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_region(q_country_sales(spark, sf_dir), enrich.country_regions(spark, sf_dir))


@register("product_part_sales", O.PRODUCT_PART_SALES)
def q_product_part_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the attributes of their part, by the join that cuts hot
    products into pieces, summed per brand and type."""
    lines = materialize(silver_of(spark, sf_dir), "silver")  # read for the hot keys and for the join
    return enrich.part_sales(enrich.with_part(lines, enrich.part_attributes(spark, sf_dir), tasks=MANY_RANGES))


@register("country_skew", O.COUNTRY_SKEW)
def q_country_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.key_share(silver_of(spark, sf_dir), "Country")


@register("country_units_salted", O.COUNTRY_UNITS_SALTED)
def q_country_units_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = silver_of(spark, sf_dir).withColumns(line_metrics())
    out = enrich.salted_sum(
        lines, "Country",
        {"UnitsSold": F.col("SoldUnits"), "GrossSales": F.col("GrossSales")},
        salt_columns=["Invoice", "StockCode"],
    )
    return out.select(
        "Country",
        F.col("UnitsSold").cast("bigint").alias("UnitsSold"),
        F.col("GrossSales").cast("decimal(28,4)").alias("GrossSales"),
    )


@register("daily_sales_year", O.DAILY_SALES_YEAR)
def q_daily_sales_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart written by Year/Month, read back for one year: the
    scan lists only that year's folders."""
    path = scratch_path(spark, "daily")
    write_layer(q_daily_sales(spark, sf_dir), path, partition_by=["Year", "Month"])
    return read_layer(spark, path).filter(F.col("Year") == 1998).select(*DAILY_COLUMNS)


@register("quarter_sales", O.QUARTER_SALES)
def q_quarter_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart by Year/Month met by a calendar filtered to the last
    quarters: the scan lists their folders only."""
    daily, calendar = scratch_path(spark, "daily"), scratch_path(spark, "calendar")
    write_layer(q_daily_sales(spark, sf_dir), daily, partition_by=["Year", "Month"])
    write_layer(enrich.month_calendar(read_layer(spark, daily)), calendar)
    return enrich.quarter_sales(read_layer(spark, daily), read_layer(spark, calendar).filter("Quarter = 4"))


@register("clustered_lines", O.with_ctes(O.CTE_SILVER, "SELECT * FROM silver"))
def q_clustered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written by ranges of stock code with bloom filters, and read
    back whole."""
    path = scratch_path(spark, "clustered")
    write_clustered(silver_of(spark, sf_dir), path, ["StockCode", "Invoice"])
    return read_layer(spark, path)


def _stored_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    grain = materialize(marts.invoice_grain(silver_of(spark, sf_dir)), "invoice-grain")
    numbers = {e: materialize(distincts.number_values(grain, c), "numbers") for e, c in distincts.ENTITIES.items()}
    return materialize(distincts.entity_bitmaps(grain, numbers), "bitmaps")


@register("country_distincts_merged", O.COUNTRY_DISTINCTS)
def q_country_distincts_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers per country, merged from stored monthly sets."""
    return distincts.merged_distincts(_stored_bitmaps(spark, sf_dir), ["Country"])


@register("country_month_distincts", O.COUNTRY_MONTH_DISTINCTS)
def q_country_month_distincts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distincts.merged_distincts(_stored_bitmaps(spark, sf_dir), distincts.GROUP)


@register("csv_roundtrip", O.CSV_ROUNDTRIP)
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as quoted CSV and read back with the raw schema."""
    path = scratch_path(spark, "csv")
    write_raw_csv(raw_lines(spark, sf_dir), path)
    return read_raw(spark, path).select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])


@register("malformed_cells", O.MALFORMED_CELLS)
def q_malformed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with an unreadable quantity or date, written as CSV and read
    back: which cells were rejected, column by column."""
    code, path = F.col("StockCode"), scratch_path(spark, "malformed")
    spoilt = raw_lines(spark, sf_dir).withColumns({
        "Quantity": F.when(code.endswith("7"), F.lit("many")).otherwise(F.col("Quantity").cast("string")),
        "InvoiceDate": F.when(code.endswith("8"), F.lit("no date")).otherwise(F.col("InvoiceDate").cast("string")),
    })
    write_raw_csv(spoilt, path)
    return read_report(read_raw(spark, path, keep_corrupt=True))


@register("layer_profile", O.LAYER_PROFILE)
def q_layer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of a written Bronze layer (partitions, schema and
    version differ by session)."""
    path = scratch_path(spark, "profile")
    write_layer(raw_lines(spark, sf_dir), path)
    return layer_profile(read_layer(spark, path)).select("Rows", "Columns")


@register("bronze_row_check", O.BRONZE_ROW_CHECK)
def q_bronze_row_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines copied to a Parquet Bronze layer; source and copy must
    agree on rows and columns."""
    return write_checked(raw_lines(spark, sf_dir), scratch_path(spark, "bronze"), "bronze")


@register("layered_run", O.LAYERED_RUN)
def q_layered_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every layer written in turn (Bronze, Silver, Gold), the blocking
    Gold checks enforced, and the row count of each written layer."""
    return run_layers(spark, raw_lines(spark, sf_dir), scratch_path(spark, "layers"))


@register("layer_fingerprints", O.LAYER_FINGERPRINTS)
def q_layer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every layer's rows as fingerprinted in the write and in its files."""
    return _validated(spark, sf_dir)["rows"]


@register("layered_run_resumed", O.LAYERED_RUN)
def q_layered_run_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, and a second one that resumes it: Bronze is copied again (its
    source is a DataFrame), the layers of the same rows stay."""
    root = scratch_path(spark, "resumed")
    run_layers(spark, raw_lines(spark, sf_dir), root)
    return run_layers(spark, raw_lines(spark, sf_dir), root, resume=True)


@register("quality_report_observed", O.QUALITY_REPORT)
def q_quality_report_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver quality report as observed while Silver is written."""
    paths = LayerPaths(scratch_path(spark, "observed"))
    run_bronze(spark, raw_lines(spark, sf_dir), paths)
    return run_silver(spark, paths)


# --- the same operators over the dirty view ------------------------------------

def _on_silver(fn):
    return lambda raw: fn(silver.silver_lines(raw))


def _csv_roundtrip(raw: DataFrame) -> DataFrame:
    path = scratch_path(raw.sparkSession, "csv-dirty")
    write_raw_csv(raw, path)
    return read_raw(raw.sparkSession, path).select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])


def _gate(raw: DataFrame) -> DataFrame:
    report: dict[str, DataFrame] = {}
    run_layers(raw.sparkSession, raw, scratch_path(raw.sparkSession, "validated-dirty"), report=report)
    return report["gate"]


_ON_DIRTY: dict[str, Callable[[DataFrame], DataFrame]] = {
    "null_counts": profile.null_counts,
    "distinct_counts": profile.distinct_counts,
    "price_quality_counts": profile.price_quality_counts,
    "raw_overview": profile.raw_overview,
    "rows_by_invoice_type": profile.rows_by_invoice_type,
    "csv_roundtrip": _csv_roundtrip,
    "clean_lines": silver.clean_lines,
    "silver_lines": silver.silver_lines,
    "silver_type_counts": lambda raw: silver.type_counts(silver.clean_lines(raw)),
    "quality_report": lambda raw: silver.quality_report(silver.clean_lines(raw)),
    "rejects_by_reason": lambda raw: silver.rejects_by_reason(silver.clean_lines(raw)),
    "gold_base": _on_silver(marts.gold_base),
    "daily_sales": _on_silver(marts.daily_sales),
    "product_performance": _on_silver(marts.product_performance),
    "customer_mart": _on_silver(marts.customer_mart),
    "country_sales": _on_silver(marts.country_sales),
    "reconciliation_gate": _gate,
}


def _register_dirty(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    register(f"{name}_dirty", O.over_dirty_lines(_ORACLE[name]))(lambda spark, sf_dir: fn(dirty_lines(spark, sf_dir)))


for _name, _fn in _ON_DIRTY.items():
    _register_dirty(_name, _fn)
