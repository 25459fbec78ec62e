"""Dimension joins whose fact side has hot keys.

A shuffled join sends all rows of a key to one task. ``hot_key_join`` finds
the keys that alone would fill more than an average task, cuts their fact
rows into pieces by a hash of the row, and repeats their dimension rows once
per piece; all other keys have one piece. Fact and dimension then meet on
(key, piece), so a key with 40 % of the rows is spread over all tasks, and
only the dimension rows of hot keys are repeated.

Finding them costs one pass over the key column: counts per key,
pre-aggregated in every map task. With T tasks a hot key holds more than
1 / T of all rows, so there are fewer than T of them; that bound makes the
table of hot keys safe to broadcast, whatever the size of the fact side.

A null key matches nothing; in a left join its rows are spread like those
of any other key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import free_names, materialize

PIECES_PER_TASK = 8  # a piece is this part of an average task


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def hot_keys(fact: DataFrame, key: str, tasks: int) -> DataFrame:
    """Key, rows and pieces of the keys with more rows than an average of
    ``tasks`` tasks (fewer than ``tasks`` rows)."""
    counts = fact.groupBy(_c(key).alias("HotKey")).agg(F.count(F.lit(1)).alias("KeyRows"))
    total = counts.agg(F.sum("KeyRows")).scalar()
    return counts.filter(F.col("KeyRows") * tasks > total).withColumn(
        "Pieces", F.ceil(F.col("KeyRows") * (tasks * PIECES_PER_TASK) / total).cast("int")
    )


def hot_key_join(fact: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None, *,
                 how: str = "left", tasks: int | None = None, piece_columns: list[str] | None = None) -> DataFrame:
    """``fact`` joined with ``dimension`` (``how``: left or inner), hot keys
    in pieces. The result has the columns of both sides, the dimension's key
    left out. ``tasks``: by default the shuffle partitions of the session.
    ``piece_columns`` decide the piece of a fact row (default: all columns);
    rows equal in all of them stay together."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    spark = fact.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dimension_key = dimension_key or key
    taken = [*fact.columns, *dimension.columns]
    hot_key, pieces, piece, other_key, other_piece = free_names(taken, "hot", "pieces", "piece", "key", "other")
    hot = materialize(hot_keys(fact, key, tasks), "hot-keys").select(
        F.col("HotKey").alias(hot_key), F.col("Pieces").alias(pieces))
    hot = F.broadcast(hot)  # fewer than ``tasks`` rows

    row = F.xxhash64(*[_c(c) for c in piece_columns or fact.columns])
    cut = fact.join(hot, _c(key).eqNullSafe(_c(hot_key)), "left").withColumn(
        piece, F.coalesce(F.pmod(row, _c(pieces)).cast("int"), F.lit(0))).drop(hot_key, pieces)
    repeated = (
        dimension.join(hot, _c(dimension_key) == _c(hot_key), "left")
        .withColumn(other_piece, F.explode(F.sequence(F.lit(0), F.coalesce(_c(pieces), F.lit(1)) - 1)))
        .drop(hot_key, pieces).withColumnRenamed(dimension_key, other_key)
    )
    met = (_c(key) == _c(other_key)) & (_c(piece) == _c(other_piece))
    return cut.join(repeated, met, how).drop(piece, other_key, other_piece)
