"""Quality classifier: a generalised additive model with pairwise terms.

Every text becomes a vector of ``FEATURES`` (counts of the whole text).
Each feature is cut into at most ``BINS`` bins of about equal weight. The
model is a sum of lookup tables: one per feature, learned by cyclic
boosting (round robin over the features, each turn a tree of depth two on
the bins of one feature, fitted to the gradient of the log loss and added
with a small step), then one per pair for the ``PAIRS`` pairs of features
whose joint table explains most of what is left, boosted the same way. A
text is scored by finding its bins and adding table entries, for a whole
batch at once.

Learning uses a bounded sample: the ``SAMPLE`` labelled rows with the
smallest hash of their id; their features (not texts) come to the driver.
Scoring covers every whole text.

Cases: null and empty texts have all counts 0, are a value of the features
like any other and so get a score; null or repeated labels (the smallest
counts) are harmless; without labels of both classes every score is the
base rate, 0.5 without any label. A row without an id is scored by its text
and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import flat, statistics
from tillroll.llm.statistics import TextCounts

SAMPLE = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 60
PAIR_ROUNDS = 30
RATE = 0.15
SMOOTH = 2.0  # added to the curvature of every leaf
THRESHOLD = 0.3
SEED = 11

FEATURES = (
    "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "stop_share", "mark_share",
    "bar_share", "other_script_share", "repeat_share", "dup_line_share", "distinct_share", "echo_share",
    "words_per_line", "caps_word_share", "longest_word",
)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text of a slice."""
    c = TextCounts(data, offsets)
    n = len(offsets) - 1
    words, chars = np.maximum(c.n_words, 1), np.maximum(c.word_chars, 1)
    letters = np.maximum(c.count(statistics.UPPER | statistics.LOWER), 1)
    # of words: without a small letter, equal to the word before, distinct, longest
    small = np.concatenate([[0], np.cumsum(statistics.LOWER[data], dtype=np.int64)])
    caps = (small[c.ends] == small[c.starts]) & statistics.UPPER[data[c.starts]] if len(c.starts) else np.zeros(0, bool)
    echo = np.zeros(len(c.hashes), bool)
    echo[1:] = (c.hashes[1:] == c.hashes[:-1]) & (c.doc[1:] == c.doc[:-1])
    _, earlier = flat.repeated(c.doc, c.hashes)
    longest = np.zeros(n)
    np.maximum.at(longest, c.doc, c.ends - c.starts)
    per_word = lambda table: c.count(flat.byte_table(table)) / words
    return np.stack([
        np.log1p(c.n_words), c.word_chars / words, c.count(statistics.UPPER) / letters,
        c.count(statistics.DIGIT) / chars, c.n_symbols / words, c.count(statistics.STOP) / words, per_word(b"!"),
        per_word(b"|"), c.count(np.arange(256) >= 192) / chars, c.n_repeat_words / words,
        c.n_dup_lines / np.maximum(c.n_lines, 1), 1 - np.bincount(c.doc[earlier], minlength=n) / words,
        np.bincount(c.doc[echo], minlength=n) / words, c.n_words / np.maximum(c.n_lines, 1),
        np.bincount(c.doc[caps], minlength=n) / words, longest,
    ], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of consecutive bins in two."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + SMOOTH) + gr**2 / (hr + SMOOTH) - g.sum() ** 2 / (h.sum() + SMOOTH)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + SMOOTH))


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A tree over consecutive bins: the value of each bin."""
    gain, cut = _best_cut(g, h)
    if depth == 0 or gain <= 1e-9:
        return np.full(len(g), _leaf(g, h))
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])


def _grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree of depth two over a grid, one cut along one axis and then one
    along the other on each side; its values and what it explains."""
    best, best_gain = np.full(g.shape, _leaf(g, h)), 0.0
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        first, cut = _best_cut(a.sum(1), b.sum(1))
        if first <= 1e-9:
            continue
        out, gain = np.empty(a.shape), first
        for rows in (slice(0, cut), slice(cut, None)):
            more, c = _best_cut(a[rows].sum(0), b[rows].sum(0))
            gain += max(more, 0.0)
            for cols in ((slice(0, c), slice(c, None)) if more > 1e-9 else (slice(None),)):
                out[rows, cols] = _leaf(a[rows, cols], b[rows, cols])
        if gain > best_gain:
            best, best_gain = (out.T if flip else out), gain
    return best, best_gain


class AdditiveModel:
    """Edges, tables and pair tables; ``score`` gives probabilities."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        y = np.asarray(y, np.float64)
        rate = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        self.base = float(np.log(rate / (1 - rate)))
        width = x.shape[1]
        grid = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], grid)) if len(y) else np.zeros(0) for j in range(width)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.coarse = [np.minimum(np.arange(len(e) + 1) * PAIR_BINS // (len(e) + 1), PAIR_BINS - 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if len(y) == 0 or y.min() == y.max():
            return
        bins = self._bins(x)
        z = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for j in range(width):
                g, h = self._gradient(z, y, bins[:, j], len(self.tables[j]))
                step = RATE * _tree(g, h)
                self.tables[j] += step
                z += step[bins[:, j]]
        # pairs by what a tree over their grid would explain of the rest
        cells = {(i, j): self.coarse[i][bins[:, i]] * PAIR_BINS + self.coarse[j][bins[:, j]]
                 for i, j in combinations(range(width), 2)}
        shape = (PAIR_BINS, PAIR_BINS)
        gains = {}
        for pair, cell in cells.items():
            g, h = self._gradient(z, y, cell, PAIR_BINS**2)
            gains[pair] = _grid_tree(g.reshape(shape), h.reshape(shape))[1]
        self.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
        self.pair_tables = [np.zeros(shape) for _ in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for pair, table in zip(self.pairs, self.pair_tables, strict=True):
                g, h = self._gradient(z, y, cells[pair], PAIR_BINS**2)
                step = RATE * _grid_tree(g.reshape(shape), h.reshape(shape))[0]
                table += step
                z += step.ravel()[cells[pair]]

    @staticmethod
    def _gradient(z: np.ndarray, y: np.ndarray, bins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(z)
        return np.bincount(bins, y - p, n), np.bincount(bins, p * (1 - p), n)

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self._bins(x)
        z = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            z += table[bins[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            z += table[self.coarse[i][bins[:, i]], self.coarse[j][bins[:, j]]]
        return _sigmoid(z)


def feature_rows(docs: DataFrame, carry: str = "doc_id bigint") -> DataFrame:
    """The feature vector of every whole text, beside its other columns."""
    names = [c.split()[0] for c in carry.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in flat.text_slices(batch.column("text")):
                x = features(data, offsets)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(row, end - row) for c in names), lists], [*names, "features"])

    return docs.select(*names, "text").mapInArrow(run, f"{carry}, features array<double>")


def train_model(docs: DataFrame, labels: DataFrame, train_rows) -> AdditiveModel:
    """Fit on a bounded sample of labelled rows; ``train_rows`` is the
    condition on doc_id that a row may be learned from."""
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).filter(train_rows)
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(SAMPLE)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # SAMPLE ids at most
    rows = feature_rows(sample.select(F.col("doc_id").cast("bigint").alias("doc_id"), "label", "text"),
                        "doc_id bigint, label int").toArrow()
    x = np.asarray(rows.column("features").combine_chunks().flatten(), np.float64).reshape(-1, len(FEATURES))
    y = rows.column("label").to_numpy()
    order = np.lexsort((*x.T, rows.column("doc_id").to_numpy()))
    return AdditiveModel(x[order], y[order])


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id and the probability that the whole text is good."""
    state = vars(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = object.__new__(AdditiveModel)
        vars(own).update(state)
        for batch in batches:
            for row, end, data, offsets in flat.text_slices(batch.column("text")):
                scores = own.score(features(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, score double")


def scored_documents(docs: DataFrame, labels: DataFrame, train_rows) -> DataFrame:
    scores = score(docs, train_model(docs, labels, train_rows))
    return scores.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
