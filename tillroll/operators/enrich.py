"""Dimension joins and skew tools.

The join of a mart with its dimension is a plain one: Spark broadcasts a
side whose size in bytes is below ``spark.sql.autoBroadcastJoinThreshold``
and otherwise shuffles, where AQE can switch strategy or split skewed
partitions. Lines meet the attributes of their product by
``hot_join.hot_key_join``, since one product may hold a large share of them.

``key_share`` reports how rows spread over a key; ``salted_sum`` sums in
two steps over (key, salt) then key. The salt is a hash of line columns,
not ``rand()``, so a retried task recomputes the same salts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.measures import line_metrics
from tillroll.operators.hot_join import hot_key_join
from tillroll.schemas import SUM_TYPE
from tillroll.sources.testtables import table

SHARE_TYPE = T.DecimalType(18, 6)


def country_regions(spark, sf_dir: str) -> DataFrame:
    """Country name -> region name, from nation and region."""
    nation = table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_name").alias("_country"), F.col("r_name").alias("Region"))


def with_region(country_mart: DataFrame, regions: DataFrame) -> DataFrame:
    """Country mart rows with their region (null when the country is not
    a known nation)."""
    return country_mart.join(regions, F.col("Country") == F.col("_country"), "left").drop("_country")


def part_attributes(spark, sf_dir: str) -> DataFrame:
    """Stock code -> brand, type, size and list price of the part."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("PartCode"),
        F.col("p_brand").alias("Brand"), F.col("p_type").alias("PartType"), F.col("p_size").cast("int").alias("PartSize"),
        F.col("p_retailprice").cast("decimal(14,4)").alias("ListPrice"),
    )


def with_part(lines: DataFrame, parts: DataFrame, *, tasks: int | None = None) -> DataFrame:
    """Silver lines with the attributes of their part (null for codes that
    are no part, such as postage)."""
    return hot_key_join(lines, parts, "StockCode", "PartCode", tasks=tasks)


def part_sales(lines: DataFrame) -> DataFrame:
    """Sales per brand and type from lines ``with_part``: units, gross,
    the same units at list price, and the lines sold below it."""
    sale = F.col("SoldUnits") > 0
    listed = F.when(sale, (F.col("SoldUnits") * F.col("ListPrice")).cast(SUM_TYPE))
    return lines.withColumns(line_metrics()).groupBy("Brand", "PartType").agg(
        F.count(F.lit(1)).alias("Lines"),
        F.sum("SoldUnits").cast("bigint").alias("UnitsSold"),
        F.sum("GrossSales").cast(SUM_TYPE).alias("GrossSales"),
        F.sum(listed).cast(SUM_TYPE).alias("ListValue"),
        F.count_if(sale & (F.col("Price") < F.col("ListPrice"))).alias("LinesBelowList"),
        F.max("PartSize").alias("LargestSize"),
    )


def month_calendar(daily: DataFrame) -> DataFrame:
    """Year, Month, Quarter of every month in the daily mart: a dimension
    of one row per month."""
    return daily.select("Year", "Month").distinct().withColumn("Quarter", F.ceil(F.col("Month") / 3).cast("int"))


def quarter_sales(daily: DataFrame, months: DataFrame) -> DataFrame:
    """Units and net revenue per country, year and quarter over the months
    given (rows of a ``month_calendar``). Over a daily mart laid out by
    Year/Month, Spark prunes the folders of all other months at run time
    (dynamic partition pruning), since their filter is on the calendar."""
    return daily.join(months, ["Year", "Month"]).groupBy("Country", "Year", "Quarter").agg(
        F.count(F.lit(1)).alias("Days"), F.sum("UnitsSold").cast("bigint").alias("UnitsSold"),
        F.sum("NetRevenue").cast("decimal(28,2)").alias("NetRevenue"),
    )


def key_share(df: DataFrame, key: str) -> DataFrame:
    """Rows per key value and its share of all rows.

    The total is a scalar subquery over the per-key counts: Spark runs it
    as its own small job and inlines the number, so no single task ever
    holds all key values and no join is needed.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("RowCount"))
    total = counts.select(F.sum("RowCount")).scalar()
    return counts.withColumn("RowShare", (F.col("RowCount") / total).cast(SHARE_TYPE))


def salted_sum(df: DataFrame, key: str, measures: dict[str, Column], *,
               salt_columns: list[str], salts: int = 32) -> DataFrame:
    """sum(measure) per key, first per (key, salt) then per key."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in salt_columns]), F.lit(salts))
    first = df.groupBy(F.col(key), salt.alias("_salt")).agg(
        *[F.sum(expr).alias(name) for name, expr in measures.items()]
    )
    return first.groupBy(key).agg(*[F.sum(name).alias(name) for name in measures])
