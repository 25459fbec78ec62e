"""Quality rules with robust multivariate outliers.

Two plain rules fail a text (``MIN_WORDS``, ``MAX_REPEAT_PERCENT``). For
the rest, each language and source has a minimum-covariance-determinant
estimate of the centre and spread of its transformed statistic vectors
(``STATISTICS``), and a text is rejected whose squared Mahalanobis
distance passes ``CUTOFF``.

A concentration step works on *all* texts of a group: with the present
centre and spread, the distances of all members are binned, per bin one
aggregate holds the moments of its members, and the bins of smallest
distance that make up ``SHARE`` of the group give the next centre, spread
and determinant. Every group has ``STARTS`` starts: medians and quartiles,
and seeded random subsets of about ``SUBSET`` members. After ``SCREEN``
steps the ``FINALISTS`` of least determinant go on until it changes by no
more than ``SETTLED`` (or ``MOST_STEPS``, since bins are coarse); the least
determinant wins, and one reweighted estimate over the members within
``REWEIGHT`` of it replaces it.
Only moments travel (a few hundred rows per group and start), so a hot
source costs no more than another. ``FLOOR``, about a tenth of the range that
a statistic moves in, keeps the spread of statistics that hardly vary (no
text of a source has symbols) from becoming zero.

Small groups lean on the estimate of all texts: a group of n takes part in
its own with the weight n^2 / (n^2 + ``LEAN``^2), as a mixture of both. The
estimate of all n texts is widened by 1 + (``LEAN`` / n)^2, so very few
texts reject next to nothing. No size switches between rules.

Cases: a null text has no words and fails; a null language or source is a
value of its own; repeated rows are judged each and count each; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm import flat
from tillroll.llm.statistics import TextCounts
from tillroll.session import materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
STATISTICS = ("log_words", "log_word_length", "root_symbol_share", "root_dup_share", "root_repeat_share")
FLOOR = (0.5, 0.1, 0.045, 0.1, 0.07)  # least standard deviations
SHARE = 0.75
STARTS, SUBSET, SCREEN, FINALISTS, MOST_STEPS, SETTLED = 5, 30, 2, 2, 12, 0.02
LEAN = 50
CUTOFF = 33.0  # a normal vector passes it with probability 4e-6
# spread of the whole of a normal group over that of its central SHARE, by five statistics
CONSISTENCY = 1.5
# 97.5 % of a normal group lie within it, and the same factor for those
REWEIGHT, REWEIGHT_CONSISTENCY = 12.83, 1.056
BINS_PER_DOUBLING = 8

P = len(STATISTICS)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
POOLED = "all"


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, group, the base counts and the statistic vector x0..x4."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in flat.text_slices(batch.column("text")):
                c = TextCounts(data, offsets)
                counts = [c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words]
                words, lines = np.maximum(c.n_words, 1), np.maximum(c.n_lines, 1)
                x = [np.log1p(c.n_words), np.log1p(c.word_chars / words),
                     np.sqrt(c.n_symbols / np.maximum(c.n_symbols + c.word_chars, 1)),
                     np.sqrt(c.n_dup_lines / lines), np.sqrt(c.n_repeat_words / words)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(row, end - row) for k in ("doc_id", "group")]
                    + [pa.array(v.astype(np.int64)) for v in counts] + [pa.array(v.astype(np.float64)) for v in x],
                    ["doc_id", "group", *COUNTS, *(f"x{j}" for j in range(P))])

    schema = ", ".join(["doc_id bigint", "group string", *(f"{c} bigint" for c in COUNTS), *(f"x{j} double" for j in range(P))])
    # null, and every string, as a distinct group name
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    group = F.concat_ws("\x1f", name("lang"), name("source"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), group.alias("group"), "text").mapInArrow(run, schema)


def squared_distance() -> Column:
    """Mahalanobis distance from ``centre`` under ``inverse`` (row by row)."""
    d = [F.col(f"x{j}") - F.col("centre")[j] for j in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        for j in range(i, P):
            term = d[i] * d[j] * F.col("inverse")[i * P + j]
            total = total + (term if i == j else 2 * term)
    return F.greatest(total, F.lit(0.0))


ESTIMATE = "group string, start int, centre array<double>, spread array<double>, inverse array<double>, log_det double, before double, members bigint"


def _medians(vectors: DataFrame) -> DataFrame:
    """Start 0 of a group: medians, and quartile distances as a diagonal."""
    cuts = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    away = vectors.groupBy("group").agg(*[F.percentile_approx(f"x{j}", cuts, 1000).alias(f"q{j}") for j in range(P)])
    spread = [F.greatest((F.col(f"q{j}")[2] - F.col(f"q{j}")[0]) / 1.349, F.lit(FLOOR[j])) for j in range(P)]
    inverse = [1 / (spread[i] * spread[i]) if i == j else F.lit(0.0) for i in range(P) for j in range(P)]
    return away.select("group", F.lit(0).alias("start"), F.array(*[F.col(f"q{j}")[1].cast("double") for j in range(P)]).alias("centre"),
                       F.array(*inverse).alias("inverse"), F.lit(None).cast("double").alias("log_det"))


def estimate(bins: pd.DataFrame, share: float, consistency: float) -> pd.DataFrame:
    """Centre and spread of one group and start from the moments of the
    bins of smallest distance that make up ``share`` of it."""
    bins = bins.sort_values("bin")
    n = bins["n"].to_numpy()
    inner = int(np.searchsorted(np.cumsum(n), share * n.sum())) + 1
    sums = bins.iloc[:inner].sum(numeric_only=True)
    size = max(float(sums["n"]), 1.0)
    mean = np.array([sums[f"t{j}"] for j in range(P)]) / size
    spread = np.zeros((P, P))
    for i in range(P):
        for j in range(i, P):
            spread[i, j] = spread[j, i] = sums[f"t{i}_{j}"] / size - mean[i] * mean[j]
    spread = consistency * spread + np.diag(np.square(FLOOR))
    first = bins.iloc[0]
    return pd.DataFrame({
        "group": [first["group"]], "start": [first["start"]], "centre": [mean.tolist()], "spread": [spread.ravel().tolist()],
        "inverse": [np.linalg.inv(spread).ravel().tolist()], "log_det": [np.linalg.slogdet(spread)[1]], "before": [first["before"]],
        "members": [int(n.sum())]})


def concentrate(bins: pd.DataFrame) -> pd.DataFrame:
    return estimate(bins, SHARE, CONSISTENCY)


def reweighted(bins: pd.DataFrame) -> pd.DataFrame:
    return estimate(bins, 1.0, REWEIGHT_CONSISTENCY)


def _moments(placed: DataFrame, bin_: Column) -> DataFrame:
    """Moments per group, start and bin (a group has at most a few hundred)."""
    return placed.groupBy("group", "start", bin_.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.first("log_det").alias("before"),
        *[F.sum(f"x{j}").alias(f"t{j}") for j in range(P)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"t{i}_{j}") for i in range(P) for j in range(i, P)])


def _estimated(moments: DataFrame, step=concentrate) -> DataFrame:
    return moments.groupBy("group", "start").applyInPandas(step, ESTIMATE)


def _least(found: DataFrame, most: int) -> DataFrame:
    """The estimates of least determinant of each group (few starts each)."""
    place = F.row_number().over(Window.partitionBy("group").orderBy("log_det", "start"))
    return found.withColumn("place", place).filter(F.col("place") <= most).drop("place")


def _subsets(vectors: DataFrame) -> DataFrame:
    """The other starts: random subsets of a group, by a hash of the vector."""
    sizes = vectors.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    starts = F.explode(F.sequence(F.lit(1), F.lit(STARTS - 1)))
    draw = F.pmod(F.xxhash64("start", *[f"x{j}" for j in range(P)]), F.lit(1 << 30)) / (1 << 30)
    drawn = vectors.join(sizes, "group").withColumn("start", starts).filter(draw < SUBSET / F.col("size"))
    drawn = drawn.withColumn("log_det", F.lit(None).cast("double"))
    return _estimated(_moments(drawn, F.lit(0)))


def estimates(vectors: DataFrame) -> DataFrame:
    """group, centre, spread, members: the reweighted estimates of least
    determinant."""
    columns = ["group", "start", "centre", "inverse", "log_det"]
    now = materialize(_medians(vectors).unionByName(_subsets(vectors).select(columns)), "mcd-starts")
    bin_ = F.floor(BINS_PER_DOUBLING * F.log2(1 + squared_distance()))
    settled = []
    for step in range(MOST_STEPS):
        found = _estimated(_moments(vectors.join(now, "group"), bin_))
        if step == SCREEN - 1:
            found = _least(found, FINALISTS)
        found = materialize(found, f"mcd-{step}")
        if step < SCREEN:
            now = found.select(columns)
            continue
        still = F.abs(F.col("log_det") - F.col("before")) > SETTLED
        if step == MOST_STEPS - 1:
            still = F.lit(False)
        settled.append(found.filter(~still).select(columns))
        now = found.filter(still).select(columns)
        if now.isEmpty():
            break
    best = materialize(_least(reduce(DataFrame.unionByName, settled), 1), "mcd-best")
    near = vectors.join(best, "group").filter(squared_distance() <= REWEIGHT)
    last = _estimated(_moments(near, F.lit(0)), reweighted).select("group", "centre", "spread")
    sizes = vectors.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    return last.join(sizes, "group")


def leaning(own: pd.DataFrame, pool: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
    """Estimates of groups as mixtures with the one of all texts."""
    out = []
    for group, centre, spread, n in own.itertuples(index=False):
        weight = n * n / (n * n + LEAN * LEAN)
        away = np.asarray(centre) - pool[0]
        mixed = weight * np.asarray(spread).reshape(P, P) + (1 - weight) * (pool[1] + weight * np.outer(away, away))
        out.append((group, (pool[0] + weight * away).tolist(), np.linalg.inv(mixed).ravel().tolist()))
    return pd.DataFrame(out, columns=["group", "centre", "inverse"])


def judged(docs: DataFrame) -> DataFrame:
    """Counts, plain rules, distance and verdict for every text."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    stats = materialize(text_statistics(docs).withColumn("base_failed", base_failed), "text-statistics")
    # texts that fail the plain rules have no say in the estimates
    sound = stats.filter(~F.col("base_failed"))
    found = materialize(estimates(sound.unionByName(sound.withColumn("group", F.lit(POOLED)))), "mcd-estimates")
    # the estimate of all texts is one row
    pool = found.filter(F.col("group") == POOLED).select("centre", "spread", "members").first()
    if pool is not None:
        wide = 1 + (LEAN / pool["members"]) ** 2
        pool = np.array(pool["centre"]), wide * np.array(pool["spread"]).reshape(P, P)

    def lean(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield leaning(part, pool)

    found = found.filter(F.col("group") != POOLED).select("group", "centre", "spread", "members").mapInPandas(
        lean, "group string, centre array<double>, inverse array<double>")
    distance = F.when(F.col("centre").isNotNull(), squared_distance())
    return stats.join(found, "group", "left").select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.coalesce(distance <= CUTOFF, F.lit(True))).alias("kept"),
        distance.alias("distance"))
