"""Mixing sources to target weights by capped water-filling.

A source may be read at most ``max_epochs`` times. Sources share a budget
of words by weight; a source whose share passes its cap is clamped there
and the rest is shared again among the others, until none is above. With
n sources that takes at most n rounds, each one aggregate over the table
of sources (rows: sources, not documents).

A source then takes every document floor(target / size) times, and once
more the documents that come first in a seeded order until the target is
met; the one that crosses it is taken for a fraction of its words. To find
the crossing without ordering a whole source in one task, the seeded order
(the MD5 of seed and id) is cut into ranges by its first ``RANGE_DIGITS``
hexadecimal digits: their sizes tell the range that holds the crossing, and
only its documents are ordered.

Cases: null and empty texts have size 0 and are taken 0 words; a null
source is a source of its own, last in the order of weights; a source of
size 0 has target 0; repeated rows are documents of their own; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.ranking import SortKey, rank_rows
from tillroll.session import materialize

RANGE_DIGITS = 3  # 4096 ranges


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_sizes(sized: DataFrame) -> DataFrame:
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"))


def cyclic_weights(sources: DataFrame, weights: list[float]) -> DataFrame:
    """Weights given to the sources in code-point order, null last."""
    ranked = rank_rows(sources, [SortKey("source", nulls_first=False)], "place_")
    values = F.array(*[F.lit(float(w)) for w in weights])
    turn = ((F.col("place_") - 1) % len(weights)).cast("int")
    return ranked.withColumn("weight", F.get(values, turn)).drop("place_")


def targets(sources: DataFrame, budget_ratio: float, max_epochs: float) -> DataFrame:
    """``sources`` (source, source_size, weight) with their targets."""
    cap = max_epochs * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = min(budget_ratio, max_epochs) * total
    level = 0.0  # words per weight
    while True:
        # clamped: the share at the present level is above the cap
        over = F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.sum(F.when(over, cap)).alias("held"),
            F.sum(F.when(~over, F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        new = (budget - (row["held"] or 0.0)) / row["open"]
        if new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def mix(docs: DataFrame, weights: list[float], budget_ratio: float = 1.5, max_epochs: float = 2.0,
        seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words) per row."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = materialize(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), order.alias("order_"),
                    F.substring(order, 1, RANGE_DIGITS).alias("bucket_")),
        "mix-sizes",
    )
    sources = materialize(targets(materialize(cyclic_weights(source_sizes(sized), weights), "mix-weights"),
                                  budget_ratio, max_epochs), "mix-targets")
    plan = sources.withColumn("goal_", F.round("target").cast("bigint")).withColumn(
        "whole_", F.when(F.col("source_size") > 0, F.expr("goal_ div source_size")).otherwise(F.lit(0)).cast("bigint")
    ).withColumn("rest_", F.col("goal_") - F.col("whole_") * F.col("source_size"))
    # what each range of a source is taken for: words left when it begins
    ranges = sized.groupBy("source", "bucket_").agg(F.sum("size").alias("words_"))
    upto = Window.partitionBy("source").orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before_", F.coalesce(F.sum("words_").over(upto), F.lit(0)))
    ranges = (
        ranges.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
        .select("r.source", "bucket_", "words_", "source_size", "target", "whole_",
                F.greatest(F.lit(0), F.col("rest_") - F.col("before_")).alias("left_"))
    )
    # rows find their range, not their source: a hot source is many ranges
    same = F.col("d.source").eqNullSafe(F.col("f.source")) & (F.col("d.bucket_") == F.col("f.bucket_"))
    rows = sized.alias("d").join(ranges.alias("f"), same).select("d.*", "words_", "source_size", "target", "whole_", "left_")
    base = F.col("whole_") * F.col("size")
    crossing = (F.col("left_") > 0) & (F.col("left_") < F.col("words_"))
    easy = rows.filter(~crossing).withColumn("taken", base + F.when(F.col("left_") > 0, F.col("size")).otherwise(F.lit(0)))
    inside = Window.partitionBy("source", "bucket_").orderBy("order_", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    tight = rows.filter(crossing).withColumn(
        "taken", base + F.least(F.col("size"), F.greatest(
            F.lit(0), F.col("left_") - F.coalesce(F.sum("size").over(inside), F.lit(0)))))
    return easy.unionByName(tight).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", F.col("size").cast("bigint").alias("size"),
        F.col("source_size").cast("bigint").alias("source_size"), F.col("target").cast("double").alias("target"),
        F.col("taken").cast("bigint").alias("taken"),
    )


def repeat_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes it. A fraction of a
    text is rounded to none or all of it: texts are not cut."""
    ratio = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    copies = mixed.groupBy("doc_id").agg(F.max(ratio).alias("copies_"))
    joined = docs.alias("d").join(copies.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")))
    return (
        joined.filter(F.col("copies_") > 0)
        .withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("copies_"))))
        .select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns])
    )
