"""LM scoring with an Elias-Fano n-gram trie.

The model is a trigram model with Dirichlet smoothing (MacKay and Peto)
over all words and all contexts:

    p1(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    P(b | a)  = (c(ab) + K2 p1(b)) / (c(a) + K2)
    P(c | ab) = (c(abc) + K3 P(c | b)) / (c(ab) + K3)

Counts cover all training texts, and no n-gram is pruned. ``VOCABULARY``
and ``CONTEXTS`` can bound the model (None: no bound): words beyond the
``VOCABULARY`` most frequent share one class, each with p1(w) / p1(class)
of its probability; the third order is used where both words of the
context are among the ``CONTEXTS`` most frequent (or the start).

Nothing of the size of the corpus is gathered in one place. Texts are cut
into blocks of about ``BLOCK_BYTES``, tokenised once. Each block sends its
distinct n-grams of orders 1 to 3 as sorted 64-bit keys (a 61-bit hash of
the words and the order) with their counts, packed by key range; a range
adds them up over all blocks and sends each block the totals of its own
n-grams, in the order in which it sent them. A block then holds exactly
the part of the model that its texts query, as a trie:

- a level is one Elias-Fano sequence of all children, in the order of
  their parents; a child is found by successor search in the range of its
  parent. Trigram children are numbered by their place among the children
  of the shorter context (Pibiri and Venturini), which keeps them small;
- an n-gram of the block that is in no training text is there too, with
  the probability of its back-off, so that every look-up ends in a hit;
- probabilities are log10 values in steps of 1 / ``STEPS`` in 16 bits.

All levels live in memory maps; texts are scored by vectorised look-ups.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end
per text. Words are identified by 64-bit hashes.

Cases: a null text counts as empty and has the end token only; repeated
rows are texts of their own; a row whose condition is null is not trained on; without
training texts all counts are 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import flat
from tillroll.llm.elias_fano import EliasFano, mapped
from tillroll.llm.sorted_groups import group_bounds, key_rows, whole_groups
from tillroll.session import materialize

BLOCK_BYTES = 14 << 20
VOCABULARY: int | None = None
CONTEXTS: int | None = None
K2 = 400.0
K3 = 400.0
STEPS = 512
LANES = 1 << 18  # tokens looked up at once
RANGE_TOKENS = 1 << 20  # tokens of all blocks together per key range

END_HASH = np.int64(0x0E4D0E4D0E4D0E4D)
CLASS_HASH = np.int64(0x0C1A0C1A0C1A0C1A)  # of the words beyond VOCABULARY
_LIFT = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- blocks --------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    """Bytes of an integer array, plane by plane, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(raw, decompressed_size=n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).ravel()


BLOCK_SCHEMA = ("block bigint, doc_ids array<bigint>, trained array<boolean>, n_words array<int>, "
                "n_vocab int, n_tokens bigint, vocab binary, tokens binary")


def token_blocks(docs: DataFrame, train_rows: Column) -> DataFrame:
    """Blocks of tokenised texts: word hashes, and tokens as their indexes."""

    def row(number: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, trained, counts, hashes = (pa.concat_arrays([p[k] for p in parts]) if k < 2 else np.concatenate([p[k] for p in parts]) for k in range(4))
        vocab, tokens, n = np.unique(hashes, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # small indexes for frequent words: they compress better
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        vocab, tokens = vocab[order], place[tokens]
        one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
        return pa.RecordBatch.from_arrays([
            pa.array([(TaskContext.get().partitionId() << 24) + number], pa.int64()), one(ids), one(trained), one(pa.array(counts.astype(np.int32))),
            pa.array([len(vocab)], pa.int32()), pa.array([len(tokens)], pa.int64()),
            pa.array([vocab.astype("<u8").tobytes()], pa.binary()), pa.array([_packed(tokens.astype("<u4"))], pa.binary()),
        ], ["block", "doc_ids", "trained", "n_words", "n_vocab", "n_tokens", "vocab", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, number = [], 0, 0
        for batch in batches:
            for a, b, data, offsets in flat.text_slices(batch.column("text")):
                starts, ends, first = flat.words(data, offsets)
                parts.append((batch.column("doc_id").slice(a, b - a), batch.column("trained").slice(a, b - a),
                              np.diff(first), flat.piece_hashes(_LOWER[data], starts, ends)))
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield row(number, parts)
                    parts, size, number = [], 0, number + 1
        if parts:
            yield row(number, parts)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(train_rows, F.lit(False)).alias("trained"))
    return source.mapInArrow(run, BLOCK_SCHEMA)


class Block:
    """The texts of one row of ``token_blocks``."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.doc_ids, self.trained = row["doc_ids"], np.array(row["trained"], bool)
        self.counts = np.array(row["n_words"], np.int64)
        self.vocab = np.frombuffer(row["vocab"], "<u8").view(np.int64)
        self.tokens = _unpacked(row["tokens"], row["n_tokens"], "<u4").astype(np.int32)
        self.doc = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)

    def sequence(self, kinds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The classes of all tokens with a start and an end around each
        text, and the text of each place."""
        size = self.counts + 2
        before = np.cumsum(size) - size
        out = np.full(int(size.sum()), end, np.int32)
        out[flat.positions(before + 1, self.counts)] = kinds[self.tokens]
        return out, np.repeat(np.arange(len(size), dtype=np.int32), size)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Block(batch.slice(k, 1).to_pylist()[0])


# --- n-grams -------------------------------------------------------------------


class Classes:
    """``top``: hashes of the most frequent words, from the most frequent,
    with their counts; None if no bound of the model needs them."""

    def __init__(self, top: list[tuple[int, int]] | None):
        hashes = np.array([h for h, _ in top or []], np.int64)
        self.words = hashes[:VOCABULARY] if VOCABULARY is not None else None
        self.contexts = hashes[:CONTEXTS] if CONTEXTS is not None else None
        self.counts = np.array([n for _, n in top or []][:VOCABULARY], np.float64)

    def of(self, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The class of each word of a block (its index; the end follows
        them, then the class of other words), the hash of each class, and
        whether it may be in a trigram context."""
        kinds = np.arange(len(vocab), dtype=np.int32)
        if self.words is not None:
            kinds[~np.isin(vocab, self.words)] = len(vocab) + 1
        hashes = np.concatenate([vocab, [END_HASH, CLASS_HASH]])
        deep = np.ones(len(hashes), bool)
        if self.contexts is not None:
            deep = np.isin(hashes, np.append(self.contexts, END_HASH))
        return kinds, hashes.view(np.uint64), deep


def gram_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from that of its context and that of its last word."""
    return flat.mix64(context * _LIFT + word)


def gram_keys(hashes: np.ndarray, order: int) -> np.ndarray:
    """Keys of n-grams: the hash above the order; the lowest bit is free."""
    return (flat.mix64(hashes) & ~np.uint64(7)) | np.uint64(2 * order)


def gram_places(sequence: np.ndarray, doc: np.ndarray, deep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all tokens (the end included), and of those with a
    trigram context."""
    token = (np.flatnonzero(doc[1:] == doc[:-1]) + 1).astype(np.int32)
    third = (np.flatnonzero(doc[2:] == doc[:-2]) + 2).astype(np.int32)
    if not deep.all():
        third = third[deep[sequence[third - 2]] & deep[sequence[third - 1]]]
    return token, third


def block_counts(block: Block, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a block, sorted, and how often its training
    texts have each. Words count by themselves, not by their class."""
    kinds, hashes, deep = classes.of(block.vocab)
    sequence, doc = block.sequence(kinds, len(block.vocab))
    token, third = gram_places(sequence, doc, deep)
    two = gram_hash(hashes[sequence[:-1]], hashes[sequence[1:]])  # by the place of the first word
    trained = block.trained.astype(np.uint64)
    marked = np.empty(len(token) + len(third), np.uint64)
    marked[: len(token)] = gram_keys(two[token - 1], 2) | trained[doc[token]]
    marked[len(token) :] = gram_keys(gram_hash(two[third - 2], hashes[sequence[third]]), 3) | trained[doc[third]]
    del two, sequence, token, third, doc
    marked.sort()
    first = np.flatnonzero(np.concatenate([[True], (marked[1:] ^ marked[:-1]) > 1]))
    many = np.add.reduceat(marked & np.uint64(1), first).astype(np.int64)
    own = marked[first] & ~np.uint64(1)
    del marked, first
    words = gram_keys(hashes[: len(block.vocab) + 1], 1)
    n = np.bincount(block.tokens[block.trained[block.doc]], minlength=len(block.vocab))
    order = np.argsort(words)
    keys, n = np.concatenate([own, words[order]]), np.concatenate([many, np.append(n, block.trained.sum())[order]])
    order = np.argsort(keys, kind="stable")  # merges two sorted runs
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


# --- counts ------------------------------------------------------------------------


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _rows(batches):
        n = np.bincount(block.tokens[block.trained[block.doc]], minlength=len(block.vocab))
        yield pa.RecordBatch.from_arrays([pa.array(block.vocab), pa.array(n.astype(np.int64))], ["key", "n"])


def frequent_words(blocks: DataFrame, size: int) -> list[tuple[int, int]]:
    counts = blocks.mapInArrow(_word_counts, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("total"))
    top = counts.filter("total > 0").orderBy(F.desc("total"), "key").limit(size).collect()
    return [(r["key"], r["total"]) for r in top]


def _gram_counts(classes: Classes, ranges: int):
    """Per block and key range: the sorted keys as differences, and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _rows(batches):
            keys, n = block_counts(block, classes)
            bounds = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(bounds)).tolist():
                own, many = keys[bounds[r] : bounds[r + 1]], n[bounds[r] : bounds[r + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r], pa.int32()), pa.array([block.number], pa.int64()), pa.array([len(own)], pa.int32()),
                     pa.array([_packed(np.diff(own, prepend=np.uint64(0)))], pa.binary()), pa.array([_packed(many)], pa.binary())],
                    ["range", "block", "size", "keys", "counts"])

    return run


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Equal parts of the key space, by the upper 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _range_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and key range: what the other blocks add to each count.
    The first row of a range has its training tokens and distinct words."""
    for table in whole_groups(batches, ["range"]):
        bounds = group_bounds(key_rows(table, ["range"]))
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield _one_range(table.slice(a, b - a))


def _one_range(table: pa.Table) -> pa.RecordBatch:
    sizes = table.column("size").to_numpy()
    starts = np.cumsum(sizes) - sizes
    keys, n = np.empty(int(sizes.sum()), np.uint64), np.empty(int(sizes.sum()), np.int64)
    for raw, many, a, k in zip(table.column("keys"), table.column("counts"), starts, sizes):
        np.cumsum(_unpacked(raw.as_py(), k, "<u8"), out=keys[a : a + k])
        n[a : a + k] = _unpacked(many.as_py(), k, "<i8")
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    total = np.add.reduceat(n[order], first)
    words = (sorted_[first] & np.uint64(7)) == 2
    others = np.empty(len(n), np.int64)
    others[order] = np.repeat(total, np.diff(first, append=len(n)))
    others -= n
    rows = len(sizes)
    once = lambda v: pa.array(np.append(v, np.zeros(rows - 1)).astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [table.column("range").combine_chunks(), table.column("block").combine_chunks(), table.column("size").combine_chunks(),
         pa.array([_packed(others[a : a + k]) for a, k in zip(starts, sizes)], pa.binary()),
         once(total[words].sum()), once((total[words] > 0).sum())], ["range", "block", "size", "others", "tokens", "words"])


def totals(blocks: DataFrame, classes: Classes) -> DataFrame:
    """The totals of each block's n-grams, one row per key range."""
    partitions = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    ranges = partitions * -(-max(size, 1) // (partitions * RANGE_TOKENS))
    sent = blocks.mapInArrow(_gram_counts(classes, ranges), "range int, block bigint, size int, keys binary, counts binary")
    dealt = sent.repartitionById(partitions, F.col("range") % partitions).sortWithinPartitions("range", "block")
    return dealt.mapInArrow(_range_totals, "range int, block bigint, size int, others binary, tokens bigint, words bigint")


# --- the trie of a block -------------------------------------------------------------


def quantised(log_p: np.ndarray) -> np.ndarray:
    return mapped(np.minimum(np.rint(-log_p * STEPS), 65535).astype(np.uint16))


class Trie:
    """All n-grams of a block. ``sequence``, ``doc``: its classes with a
    start and an end per text, and the text of each place; ``counted``:
    keys -> counts over all training texts; ``count1``, ``p1``: of each
    class."""

    def __init__(self, sequence: np.ndarray, doc: np.ndarray, hashes: np.ndarray, deep: np.ndarray, counted,
                 count1: np.ndarray, p1: np.ndarray):
        size = len(hashes)
        token, third = gram_places(sequence, doc, deep)
        two = sequence[token - 1].astype(np.int64) * size + sequence[token]
        pairs = _distinct(two)
        a, b = (pairs // size).astype(np.int32), (pairs % size).astype(np.int32)
        hash2 = gram_hash(hashes[a], hashes[b])
        n2 = counted(gram_keys(hash2, 2)).astype(np.float64)
        p2 = (n2 + K2 * p1[b]) / (count1[a] + K2)
        del a
        self.level2 = EliasFano(pairs, size**2)  # parent and child in one number: children follow their parent
        self.prob2 = quantised(np.log10(p2))
        first = np.searchsorted(pairs, np.arange(size + 1) * size)
        self.pointers = EliasFano(first, len(pairs) + 1)
        places = len(pairs)
        del pairs
        # third level: the parent is a place of level 2, the child its place
        # among the children of the context's last word
        self.span = int(np.diff(first).max(initial=0)) + 1
        self.place = _in_order(self.level2.find, two).astype(np.int32)
        del two
        self.third = np.searchsorted(token, third).astype(np.int32)
        self.children = self.place[self.third] - _in_order(self.pointers.access, sequence[third - 1])
        del token, third
        self.children += self.place[self.third - 1].astype(np.int64) * self.span
        triples = _distinct(self.children)
        self.level3 = EliasFano(triples, max(places, 1) * self.span)
        prob3 = [np.zeros(0)]
        for k in range(0, len(triples), LANES):
            parent, relative = np.divmod(triples[k : k + LANES], self.span)
            shorter = first[b[parent]] + relative
            n3 = counted(gram_keys(gram_hash(hash2[parent], hashes[b[shorter]]), 3))
            prob3.append(np.log10((n3 + K3 * p2[shorter]) / (n2[parent] + K3)))
        self.prob3 = quantised(np.concatenate(prob3))

    def log_p(self) -> np.ndarray:
        """log10 probability of each token's class in its context."""
        steps = self.prob2[self.place].astype(np.int32)
        steps[self.third] = self.prob3[_in_order(self.level3.find, self.children)]
        return -steps / STEPS

    @property
    def bytes(self) -> int:
        return self.prob2.nbytes + self.prob3.nbytes + self.level2.bytes + self.level3.bytes + self.pointers.bytes


def _in_order(look_up, wanted: np.ndarray) -> np.ndarray:
    """``look_up`` of all numbers, smallest first: neighbours lie together."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted), np.int64)
    for k in range(0, len(order), LANES):
        out[order[k : k + LANES]] = look_up(wanted[order[k : k + LANES]])
    return out


def _distinct(numbers: np.ndarray) -> np.ndarray:
    out = np.sort(numbers)
    return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out


SCORE_SCHEMA = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                "base_score double, score double")


def score_block(block: Block, classes: Classes, others: np.ndarray, n: int, v: int) -> pa.RecordBatch:
    """``others``: what the other blocks add to the counts of ``block_counts``."""
    keys, total = block_counts(block, classes)
    total += others
    counted = lambda wanted: _in_order(lambda some: total[np.searchsorted(keys, some)], wanted)
    kinds, hashes, deep = classes.of(block.vocab)
    known = counted(gram_keys(hashes[:-1], 1))
    unit = n + 0.5 * (v + 1)
    log_word = np.log10((known + 0.5) / unit)
    count1 = np.append(known, 0).astype(np.float64)
    p1 = (count1 + 0.5) / unit
    if classes.words is not None:
        # the class of all other words: their mass and that of one unknown word
        count1[-1] = n - classes.counts.sum() - known[-1]
        p1[-1] = (count1[-1] + 0.5 * (v - len(classes.words) - (known[-1] > 0)) + 0.5) / unit
    p1 = np.maximum(p1, 1e-300)
    sequence, doc = block.sequence(kinds, len(block.vocab))
    trie = Trie(sequence, doc, hashes, deep, counted, count1, p1)
    inside = np.where(kinds == len(block.vocab) + 1, log_word[:-1] - np.log10(p1[-1]), 0.0)
    sizes = block.counts + 1
    per_text = lambda values, end: flat.segment_sums(values[block.tokens], block.counts) + end
    score = flat.segment_sums(trie.log_p(), sizes) + per_text(inside, 0.0)
    return pa.RecordBatch.from_arrays([
        pa.array(block.doc_ids, pa.int64()), pa.array(~block.trained), pa.array(sizes),
        pa.array(per_text((known[:-1] > 0).astype(np.int64), int(known[-1] > 0))), pa.array(np.full(len(sizes), n, np.int64)),
        pa.array(per_text(log_word[:-1], log_word[-1])), pa.array(score),
    ], [c.split()[0] for c in SCORE_SCHEMA.split(", ")])


@contextmanager
def shuffle_files_freed(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of what runs in here when it ends,
    not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def score(docs: DataFrame, train_rows: Column) -> DataFrame:
    """Base score and model score of every text; ``train_rows``: the
    condition on doc_id that a text is learned from."""
    blocks = materialize(token_blocks(docs, train_rows), "lm-blocks")
    bound = max(VOCABULARY or 0, CONTEXTS or 0)
    classes = Classes(frequent_words(blocks, bound) if bound else None)
    with shuffle_files_freed(docs.sparkSession):
        replies = materialize(totals(blocks, classes), "lm-totals")
    n, v = replies.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("range").to_numpy())
        raw, size = right.column("others").to_pylist(), right.column("size").to_pylist()
        others = np.concatenate([_unpacked(raw[k], size[k], "<i8") for k in order.tolist()])
        return pa.Table.from_batches([score_block(b, classes, others, n, v) for b in _rows(iter(left.to_batches()))])

    return blocks.groupBy("block").cogroup(replies.select("block", "range", "size", "others").groupBy("block")).applyInArrow(run, SCORE_SCHEMA)
