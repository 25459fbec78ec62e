"""Deterministic revenue ranks: ``row_number`` over a total order.

A rank over the whole table is a window without a partition, which Spark
runs in a single task. That is fine for a table whose size is bounded
(``rank_global``: the rows of a top-k report) but not for one that grows
with the data. ``rank_rows`` takes ranks from row positions, at every size:

1. write the rows once to the shared checkpoint folder: dealing them out by
   ranges reads them twice (a sample for the bounds, then the rows), and what
   made them, an aggregate over the lines, would run twice,
2. range-partition the rows on the *whole* sort key (e.g. NetRevenue and
   StockCode, so a revenue shared by a third of all rows is still split),
   sort each range, and write it with the number of its range and the
   position of each row in it. Spark numbers the rows of a partition in their
   order; no window and no second sort,
3. take the number of rows of each range from the written positions: one
   number per range, and ``ranges`` of them whatever the size of the input,
4. rank = rows of all earlier ranges + position.

Ranges follow the order of the key, so the result equals the single-task
``row_number``. The write pins the assignment: a task that runs again
after the loss of an executor reads the same positions.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import free_names, materialize


@dataclass(frozen=True)
class SortKey:
    column: str
    descending: bool = False
    nulls_first: bool | None = None  # default: first when ascending, last when descending

    @property
    def nulls_come_first(self) -> bool:
        return (not self.descending) if self.nulls_first is None else self.nulls_first

    def order(self) -> Column:
        c = F.col(f"`{self.column}`")
        if self.descending:
            return c.desc_nulls_first() if self.nulls_come_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_come_first else c.asc_nulls_last()


def revenue_order(*keys: str) -> list[SortKey]:
    """NetRevenue high to low, ties broken by the grain key ascending."""
    return [SortKey("NetRevenue", descending=True)] + [SortKey(k) for k in keys]


def rank_global(df: DataFrame, keys: list[SortKey], rank_col: str) -> DataFrame:
    """Single-task rank; only for inputs with a known small size bound."""
    w = Window.orderBy(*[k.order() for k in keys])
    return df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))


def rank_rows(df: DataFrame, keys: list[SortKey], rank_col: str, *, ranges: int | None = None) -> DataFrame:
    """Exact global rank (bigint, from 1) over ``ranges`` tasks, by default
    as many as the session has shuffle partitions. Columns keep their order;
    the rank comes last."""
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [k.order() for k in keys]
    in_range, place, range_, before = free_names([*df.columns, rank_col], "range", "place", "of_range", "before")
    placed = materialize(df, "unranked").repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumns({
        in_range: F.spark_partition_id(),
        # the lower 33 bits count the rows of a partition
        place: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    })
    written = materialize(placed, "rank-input")
    sizes = dict(written.groupBy(in_range).agg(F.max(place) + 1).collect())
    earlier = accumulate([0, *[sizes.get(r, 0) for r in range(ranges)]])
    starts = spark.createDataFrame(list(zip(range(ranges), earlier, strict=False)), f"`{range_}` int, `{before}` bigint")
    # one row per range
    ranked = written.join(F.broadcast(starts), F.col(f"`{in_range}`") == F.col(f"`{range_}`"))
    rank = F.col(f"`{before}`") + F.col(f"`{place}`") + 1
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], rank.cast("bigint").alias(rank_col))
