"""Exact distinct counts that can be stored and merged.

A count of distinct customers per country and month cannot be summed to a
country: customers return. ``entity_bitmaps`` stores sets instead of
counts. Every customer and invoice gets a dense number (its rank among the
distinct values), and per (Country, Year, Month) a bitmap of 32,768 numbers
each says which occur. ``merged_distincts`` ORs the bitmaps of any coarser
group and counts their bits: exact, without the lines.

A bitmap is at most 4 KB, a group has one per stretch of numbers that it
touches. New months add rows to the stored table; numbers of known values
must then stay, so ``number_values`` continues a numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.ranking import SortKey, rank_rows
from tillroll.schemas import CUSTOMER_ID

ENTITIES = {"Orders": "Invoice", "Customers": CUSTOMER_ID}
GROUP = ["Country", "Year", "Month"]


def number_values(grain: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """Value, Number: the distinct non-null values of a column, numbered
    from 0 without gaps. ``known`` (Value, Number) keeps its numbers; values
    not in it follow."""
    values = grain.select(F.col(f"`{column}`").alias("Value")).filter("Value IS NOT NULL").distinct()
    if known is None:
        return rank_rows(values, [SortKey("Value")], "Number").withColumn("Number", F.col("Number") - 1)
    first = F.coalesce(known.agg(F.max("Number") + 1).scalar(), F.lit(0))
    fresh = rank_rows(values.join(known, "Value", "left_anti"), [SortKey("Value")], "Number")
    return known.unionByName(fresh.withColumn("Number", F.col("Number") - 1 + first))


def entity_bitmaps(grain: DataFrame, numbers: dict[str, DataFrame]) -> DataFrame:
    """Country, Year, Month, Entity, Stretch, Bits over an invoice grain.
    ``numbers``: entity -> Value, Number. A group without any value of an
    entity has one empty bitmap, so that merged counts list it with 0."""
    dated = grain.select(
        "Country", F.year("SaleDate").alias("Year"), F.month("SaleDate").alias("Month"),
        *[F.col(f"`{c}`").alias(e) for e, c in ENTITIES.items()],
    )
    frames = []
    for entity in ENTITIES:
        # once per group and value before the join, so no hot invoice or customer travels
        pairs = dated.select(*GROUP, F.col(entity).alias("Value")).distinct()
        number = F.coalesce(F.col("Number"), F.lit(-1))
        frames.append(
            pairs.join(numbers[entity], "Value", "left")
            .groupBy(*GROUP, F.lit(entity).alias("Entity"),
                     F.when(number >= 0, F.bitmap_bucket_number(number + 1)).otherwise(F.lit(0)).alias("Stretch"))
            .agg(F.bitmap_construct_agg(F.when(number >= 0, F.bitmap_bit_position(number + 1))).alias("Bits"))
        )
    return frames[0].unionByName(frames[1])


def merged_distincts(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Orders and Customers per ``by`` (columns of GROUP, or none) from
    stored bitmaps."""
    sets = bitmaps.groupBy(*by, "Entity", "Stretch").agg(F.bitmap_count(F.bitmap_or_agg("Bits")).alias("Bits"))
    return sets.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("Entity") == e, F.col("Bits"))), F.lit(0)).cast("bigint").alias(e) for e in ENTITIES
    ])
