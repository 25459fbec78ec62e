"""Connected components of an edge table, by alternating star steps.

Each round points every node's larger neighbours at its smallest one, then
its smaller ones (Kiveris et al., "Connected Components in MapReduce and
Beyond"); the edges become stars in a logarithmic number of rounds. A
round is written to the shared checkpoint folder, which cuts the lineage;
nothing but a count and a checksum reaches the driver.

The centre of a star has as many rows as its component has nodes. Nodes
with more rows than an average task are cut into pieces, and their row of
the other side is repeated once per piece (fewer than two such nodes per
task, which bounds the broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize


def _with_least(edges: DataFrame, rows: int) -> DataFrame:
    """Every edge with the smallest neighbour of its ``a``; ``rows`` is the
    number of edges."""
    limit = max(1, rows // int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = edges.groupBy("a").agg(F.min("b").alias("least"), F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("pieces"))
    hot = near.filter("pieces > 1").select("a", "pieces")
    piece = F.pmod(F.xxhash64("b"), F.coalesce("pieces", F.lit(1))).cast("int")
    cut = edges.join(F.broadcast(hot), "a", "left").select("a", "b", piece.alias("piece"))
    return cut.join(near.select("a", "least", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")), ["a", "piece"])


def _round(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _with_least(both, 2 * rows).filter("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
    # the smallest neighbour itself gives the edge from the node to it
    small = _with_least(large, rows).select(
        F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b"))
    return small.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of ``edges`` (a, b: bigint, not null) that
    is not the smallest of its component; root is the smallest."""
    sorted_edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = materialize(sorted_edges.distinct(), "star-edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
        seen = mark
        now = materialize(_round(now, mark[0]), "star-edges")
