"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of the hashes of its character n-grams (``NGRAMS``
characters of ``<word>``, lower-case); its vector is the mean of their
embeddings. Segments are windows of ``SEGMENT`` words that overlap by half, so
that every phrase of up to half a segment stands whole in one. A segment is
the average of its distinct words, padded to ``SEGMENT`` with a zero vector (so that one word said over
and over weighs as much as one said once), and a linear softmax over it
gives the probability of the toxic class. Embeddings
and softmax are trained together by minibatch gradient steps (Adagrad) in
numpy, the embeddings from zero and the softmax from seeded random weights.
An unseen misspelling shares n-grams, and so vectors, with the words
it comes from.

A whole text is judged by its most toxic segment: a few words in a long
text count as much as in a short one. Training follows the same idea:
segments first carry the label of their text, then segments of toxic texts
in which the model finds nothing are left out.

Learning uses a bounded sample: ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``
labelled rows, those with the smallest hash of their id, and of each class
no further rows once they hold ``SAMPLE_BYTES``. Every sampled text is
learned from whole. A quarter of the sampled texts is kept out of the
training to fit the step from the strongest segment of the whole text to
the probability of the text. Scoring covers every whole text.

Softmax over two classes is linear in the mean, so after training every
n-gram bucket is one number, and a text is scored by sums over the distinct
words of its batch.

Cases: null and empty texts have no segment and get the score of an empty
bag (the bias alone, at most the base rate); labels that are null, repeated
(the largest counts) or of unknown ids are harmless; without any labels of
one class every score is the base rate. A row without an id is scored by its
text and never learned from; rows of one id are each judged by their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import flat
from tillroll.session import free_names

BUCKETS = 1 << 18
NGRAMS = (3, 4, 5)
DIMENSIONS = 8
SEGMENT = 32
SAMPLE_TOXIC = 2500
SAMPLE_CLEAN = 5000
SAMPLE_BYTES = 20 << 20  # per class
EPOCHS = 3
LEAST_STEPS = 150  # small samples are passed through more often
BATCH = 512  # segments
RATE = 1.0
THRESHOLD = 0.7
SEED = 7
PORTION = 1 << 15  # distinct words, or segments, taken apart at once


@dataclass
class Words:
    """The words of some texts: distinct ones and where they stand."""

    which: np.ndarray  # distinct word of each word
    first_word: np.ndarray  # per text
    grams: np.ndarray  # buckets of the n-grams of the distinct words, flat
    gram_counts: np.ndarray  # per distinct word


def word_grams(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram buckets of words given as flat UTF-8, each between < and >;
    flat, and how many each word has."""
    heads = np.concatenate([[0], np.cumsum(~flat.CONTINUATION[raw])])
    at = heads[np.concatenate([[0], np.cumsum(lengths)])]
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.diff(at) + 2
    before = np.cumsum(size) - size
    marked = np.empty(int(size.sum()), np.uint64)
    marked[before] = 60
    marked[before + size - 1] = 62
    marked[flat.positions(before + 1, size - 2)] = points
    owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
    grams, owners = [], []
    for n in NGRAMS:
        windows = flat.window_hashes(marked, n)
        whole = owner[: len(windows)] == owner[n - 1 :]
        grams.append((windows[whole] % np.uint64(BUCKETS)).astype(np.int32))
        owners.append(owner[: len(windows)][whole])
    owners_flat = np.concatenate(owners)
    order = np.argsort(owners_flat, kind="stable")
    return np.concatenate(grams)[order], np.bincount(owners_flat, minlength=len(size))


def subwords(column: pa.Array) -> Words:
    """The words of a text column. Texts are hashed slice by slice, and the
    distinct words taken apart in portions, which bounds the memory."""
    local, counts, own_hashes, own_raw, own_lengths = [], [], [], [], []
    for _, _, data, offsets in flat.text_slices(column, 1 << 20):
        starts, ends, first = flat.words(data, offsets)
        distinct, sample, number = np.unique(flat.piece_hashes(data, starts, ends), return_index=True, return_inverse=True)
        lengths = (ends - starts)[sample]
        local.append(number.astype(np.int32))
        counts.append(np.diff(first))
        own_hashes.append(distinct)
        own_raw.append(data[flat.positions(starts[sample], lengths)])
        own_lengths.append(lengths)
    first_word = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
    if first_word[-1] == 0:
        return Words(np.zeros(0, np.int64), first_word, np.zeros(0, np.int32), np.zeros(0, np.int64))
    _, pick, number = np.unique(np.concatenate(own_hashes), return_index=True, return_inverse=True)
    begins = np.cumsum([0, *map(len, own_hashes)])
    which = np.concatenate([number[a + own].astype(np.int32) for a, own in zip(begins, local, strict=False)])
    raw, lengths = np.concatenate(own_raw), np.concatenate(own_lengths)
    del local, own_hashes, own_raw, own_lengths, number
    before = (np.cumsum(lengths) - lengths)[pick]
    lengths = lengths[pick]
    parts = []
    for a in range(0, len(pick), PORTION):
        own = slice(a, a + PORTION)
        parts.append(word_grams(raw[flat.positions(before[own], lengths[own])], lengths[own]))
    gram_counts = np.concatenate([p[1] for p in parts])
    grams, at = np.empty(int(gram_counts.sum()), np.int32), 0
    parts.reverse()
    while parts:  # a portion goes as it is copied
        part, _ = parts.pop()
        grams[at : at + len(part)] = part
        at += len(part)
    return Words(which, first_word, grams, gram_counts)


def segments_of(first_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words and sizes of the segments of texts, and segments per
    text; the last segment of a text holds what is left."""
    n_words = np.diff(first_word)
    step = SEGMENT // 2
    per_text = np.where(n_words > 0, 1 + -(-np.maximum(n_words - SEGMENT, 0) // step), 0)
    starts = np.repeat(first_word[:-1], per_text) + step * flat.positions(np.zeros(len(per_text), np.int64), per_text)
    return starts, np.minimum(SEGMENT, np.repeat(first_word[1:], per_text) - starts), per_text


def distinct_in_segments(which: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each segment, flat, and how many they are."""
    span = int(which.max()) + 1 if len(which) else 1
    words, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for a in range(0, len(sizes), PORTION):
        own = sizes[a : a + PORTION]
        segment = np.repeat(np.arange(len(own)), own)
        keys = np.sort(segment * span + which[flat.positions(starts[a : a + PORTION], own)])
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        segment = keys // span
        words.append((keys - segment * span).astype(np.int32))
        counts.append(np.bincount(segment, minlength=len(own)))
    return np.concatenate(words), np.concatenate(counts)


@dataclass
class Model:
    weights: np.ndarray  # float32 per bucket
    bias: float
    slope: float  # from the strongest segment's logit to the text's logit
    shift: float
    base_rate: float

    def segment_logits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        sums = flat.segment_sums(self.weights[words.grams], words.gram_counts)
        value = sums / np.maximum(words.gram_counts, 1)
        starts, sizes, per_text = segments_of(words.first_word)
        which, counts = distinct_in_segments(words.which, starts, sizes)
        return self.bias + flat.segment_sums(value[which].astype(np.float64), counts) / SEGMENT, per_text

    def score(self, column: pa.Array) -> np.ndarray:
        logits, per_text = self.segment_logits(subwords(column))
        top = np.full(len(per_text), min(self.bias, _logit(self.base_rate)))
        full = per_text > 0
        if full.any():
            top[full] = np.maximum.reduceat(logits, (np.cumsum(per_text) - per_text)[full])
        return _sigmoid(self.slope * top + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def _numbered(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with inverse for small non-negative integers."""
    seen = np.zeros(size, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[values]


def _train(words: Words, which: np.ndarray, counts: np.ndarray, segments: np.ndarray, labels: np.ndarray,
           rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, softmax weights and biases from the given segments;
    ``which`` and ``counts``: the distinct words of all segments."""
    table = np.zeros((BUCKETS, DIMENSIONS), np.float32)  # n-grams never met say nothing
    soft = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_table = np.full((BUCKETS, DIMENSIONS), 1e-6, np.float32)
    seen_soft, seen_bias = np.full_like(soft, 1e-6), np.full_like(bias, 1e-6)
    gram_at = np.cumsum(words.gram_counts) - words.gram_counts
    word_at = np.cumsum(counts) - counts
    batches = max(1, len(segments) // BATCH)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // batches))):
        for batch in np.array_split(rng.permutation(segments), batches):
            own, where = _numbered(which[flat.positions(word_at[batch], counts[batch])], len(gram_at))
            grams_of = words.gram_counts[own]
            used, place = _numbered(words.grams[flat.positions(gram_at[own], grams_of)], BUCKETS)
            vectors = table[used]
            word = np.add.reduceat(vectors[place], np.cumsum(grams_of) - grams_of) / grams_of[:, None]
            bag = np.add.reduceat(word[where], np.cumsum(counts[batch]) - counts[batch]) / np.float32(SEGMENT)
            z = bag @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            d_soft, d_bias = bag.T @ p / len(batch), p.mean(0)
            d_at = np.repeat(p @ soft.T / np.float32(SEGMENT), counts[batch], axis=0)
            d_table = np.empty_like(vectors)
            for k in range(DIMENSIONS):
                d_word = np.bincount(where, d_at[:, k], len(own)) / grams_of
                d_table[:, k] = np.bincount(place, np.repeat(d_word, grams_of), len(used))
            for value, seen, step in ((soft, seen_soft, d_soft), (bias, seen_bias, d_bias)):
                seen += step * step
                value -= RATE * step / np.sqrt(seen)
            seen_table[used] += d_table * d_table
            table[used] -= RATE * d_table / np.sqrt(seen_table[used])
    return table, soft, bias


def fit(texts: list[str] | pa.Array, toxic: np.ndarray) -> Model:
    """Train on the sampled texts."""
    toxic = np.asarray(toxic, np.int64)
    base = float(toxic.mean()) if len(toxic) else 0.0
    flat_model = Model(np.zeros(BUCKETS, np.float32), _logit(base), 1.0, 0.0, base)
    if len(toxic) == 0 or toxic.min() == toxic.max():
        return flat_model
    words = subwords(pc.utf8_lower(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())))
    starts, sizes, per_text = segments_of(words.first_word)
    which, counts = distinct_in_segments(words.which, starts, sizes)
    text = np.repeat(np.arange(len(per_text)), per_text)
    labels = toxic[text]
    rng = np.random.default_rng(SEED)
    learned = rng.permutation(len(per_text)) % 4 != 0  # the others serve the calibration
    keep = np.flatnonzero(learned[text])
    model = flat_model
    for _ in range(2):
        if not len(keep):
            break
        table, soft, bias = _train(words, which, counts, keep, labels, rng)
        model = Model((table @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]), 1.0, 0.0, base)
        logits, _ = model.segment_logits(words)
        top = np.full(len(per_text), -np.inf)
        np.maximum.at(top, text, logits)
        # of a toxic text stay the strongest segment and those that look toxic
        keep = np.flatnonzero(learned[text] & ((labels == 0) | (logits > 0) | (logits == top[text])))
    unseen = (per_text > 0) & ~learned
    if model is not flat_model and 0 < toxic[unseen].sum() < unseen.sum():
        model.slope, model.shift = _calibrate(top[unseen], toxic[unseen])
    return model


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on one number (Newton steps, with
    smoothed targets so that separable data stays finite)."""
    scale = float(np.std(x)) or 1.0
    design = np.stack([x / scale, np.ones_like(x)], 1)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    beta = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(design @ beta)
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (target - p))
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    slope = max(beta[0] / scale, 1e-3)
    return float(slope), float(beta[1])


def train_model(docs: DataFrame, labels: DataFrame, train_rows) -> Model:
    """Fit on a bounded sample of labelled rows; ``train_rows`` is the
    condition on doc_id that a row may be learned from."""
    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).filter(train_rows)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64(F.lit(SEED), "doc_id")
    chosen = marked.filter("toxic = 1").orderBy(order, "doc_id").limit(SAMPLE_TOXIC).unionByName(
        marked.filter("toxic = 0").orderBy(order, "doc_id").limit(SAMPLE_CLEAN))
    # at most SAMPLE_TOXIC + SAMPLE_CLEAN ids
    sized = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes")).withColumn("place", order).collect()
    held: dict[int, int] = {}
    ids = []
    for row in sorted(sized, key=lambda x: (x["place"], x["doc_id"])):
        before = held.get(row["toxic"], 0)
        held[row["toxic"]] = before + row["bytes"]
        if before < SAMPLE_BYTES:
            ids.append((row["doc_id"], row["toxic"]))
    kept = docs.sparkSession.createDataFrame(ids, "doc_id bigint, mark int")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(kept), "doc_id").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return fit(rows.column("text").combine_chunks(), rows.column("mark").to_numpy())


def score(docs: DataFrame, model: Model, carry: list[str] | None = None, name: str = "score") -> DataFrame:
    """The probability that the whole text is toxic, beside the columns to
    ``carry`` (default: doc_id as bigint)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # 1 MB
    carried = [F.col("doc_id").cast("bigint").alias("doc_id")] if carry is None else [F.col(f"`{c}`") for c in carry]
    kept = docs.select(*carried)
    rows = kept if "text" in kept.columns else docs.select(*carried, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**shared.value)
        for batch in batches:
            lowered = pc.utf8_lower(pc.fill_null(batch.column("text"), ""))
            for row, end, _, _ in flat.text_slices(lowered):
                scores = own.score(lowered.slice(row, end - row))
                columns = [batch.column(c).slice(row, end - row) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], [*names, name])

    names = kept.columns
    return rows.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))


def clean_documents(docs: DataFrame, labels: DataFrame, train_rows) -> DataFrame:
    """The rows of ``docs`` that are not rejected, each judged by its own
    text, whatever its id."""
    name, = free_names(docs.columns, "toxicity")
    scored = score(docs, train_model(docs, labels, train_rows), docs.columns, name)
    return scored.filter(F.col(name) < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def scored_documents(docs: DataFrame, labels: DataFrame, train_rows) -> DataFrame:
    scores = score(docs, train_model(docs, labels, train_rows))
    return scores.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
