"""N-gram Jaccard join by a MinHash LSH forest, verified exactly.

The shingles of a text are its windows of ``SHINGLE`` words (one shingle of
all its words if it has fewer, none without words). Texts with the same
set of shingles form a class; only its representative, the smallest id,
takes part in the join, so copies are never expanded into pairs.

1. *Forest.* A signature holds ``TREES`` x ``DEPTH`` minimum hashes. Each
   tree sorts the representatives by their part of the signature; the
   common prefixes of neighbours in that order are its trie. Texts meet at
   their longest common prefix first. The prefix is then shortened, and a
   text goes on meeting others until the recall of the least similar link
   that a text of its size can have, 1 - (1 - s^k)^trees, reaches ``RECALL``
   (``depths``): sets of few shingles attain few similarities, so short texts
   stop earlier, and those of fewer than ``FEWEST`` shingles, which no
   other set can link, never start. Texts that longer prefixes have
   connected are not compared again at shorter ones.
2. *Candidates.* Two representatives that meet are candidates unless their
   whole signatures agree in fewer than ``LEAST`` of all places, which a
   pair at the threshold does with probability below 1e-8. Candidates leave
   as a spanning forest, not as pairs.
3. *Verification.* The texts of each connected group of candidates meet
   once, and the exact Jaccard similarity of all their pairs is computed
   with integer counts (5 x common >= 4 x union for 0.8).

A node or group of more than ``TILE`` members is cut into blocks by hash;
every pair of blocks is one tile, a unit of work of bounded size. Pairs
live inside a tile only: what leaves it is, per representative, a number
of links and a spanning edge.

Each set of shingles has a number of its own, under which it is matched,
verified and linked; ids of documents only name the result. A row without
an id, or one of several texts under one id, therefore has its own links.

Cases: a null text is an empty text, in a class of its own with no links
(as is any text without words); a row with a null id has the class and the
links of its text, and the class id is null where no row of the class has an
id; repeated rows of an id are copies of each other (of differing texts
under one id, each row has the class and links of its own text); an empty
table gives an empty result. The number of links counts rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import flat
from tillroll.llm.components import components
from tillroll.llm.sorted_groups import group_bounds, key_rows, whole_groups
from tillroll.session import free_names, materialize

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
TREES = 16
DEPTH = 6
RECALL = 0.9995
LEAST = 0.55
TILE = 256

_RNG = np.random.default_rng(10)
_MULTIPLY = _RNG.integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)


def prefix_length(threshold: float = float(THRESHOLD), trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets in some
    tree with probability ``recall`` (1 if none does)."""
    for k in range(depth, 1, -1):
        if 1 - (1 - threshold**k) ** trees >= recall:
            return k
    return 1


def least_similarity(size: int, threshold: Fraction = THRESHOLD) -> Fraction | None:
    """The smallest Jaccard similarity, at least the threshold and below 1,
    that a set of ``size`` elements can have with another (None: no such)."""
    found = []
    for other in range(math.ceil(size * threshold), math.floor(size / threshold) + 1):
        common = math.ceil(threshold * (size + other) / (1 + threshold))
        if common <= min(size, other) and common < size + other - common:
            found.append(Fraction(common, size + other - common))
    return min(found, default=None)


# from SMALL elements on, a set has sizes enough beside it to come near the threshold
SMALL = 64
_LEAST = [least_similarity(n) for n in range(SMALL)]
FEWEST = next(n for n, s in enumerate(_LEAST) if s)
_DEPTHS = np.array([prefix_length(float(s or 1)) for s in _LEAST] + [prefix_length()])


def depths(sizes: np.ndarray) -> np.ndarray:
    """The prefix length down to which texts of these sizes are matched."""
    return _DEPTHS[np.minimum(sizes, SMALL)]


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, flat; and counts."""
    n = len(offsets) - 1
    starts, ends, first = flat.words(data, offsets)
    counts = np.diff(first)
    hashes = flat.piece_hashes(data, starts, ends)
    doc = np.repeat(np.arange(n), counts)
    windows = flat.window_hashes(hashes, SHINGLE)
    whole = doc[: len(windows)] == doc[SHINGLE - 1 :] if len(windows) else np.zeros(0, bool)
    owner, values = [doc[: len(windows)][whole]], [windows[whole]]
    for size in range(1, SHINGLE):  # short texts: all their words
        short = np.flatnonzero(counts == size)
        if len(short):
            at = first[short]
            grown = np.stack([hashes[at + k] for k in range(size)] + [np.full(len(at), size, np.uint64)], axis=1)
            values.append(flat.window_hashes(grown.ravel(), size + 1)[:: size + 1])
            owner.append(short)
    owner, values = np.concatenate(owner), np.concatenate(values)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=n)


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """TREES x DEPTH minimum hashes (uint32) of each non-empty set."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(starts), TREES * DEPTH), np.uint32)
    for k in range(TREES * DEPTH):
        out[:, k] = np.minimum.reduceat(values * _MULTIPLY[k] + _ADD[k], starts) >> np.uint64(32)
    return out


TEXT = ["doc_id", "text_hash", "text_bytes"]  # names a row by its id and text
SET = ["key1", "key2", "n_shingles"]


def text_names() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
            F.octet_length(text).cast("bigint").alias("text_bytes")]


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equal in all names, nulls too."""
    tests = [left[c].eqNullSafe(right[c]) for c in names]
    return reduce(Column.__and__, tests)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, hash and bytes of the text, the 128-bit key and size of its
    shingle set, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in flat.text_slices(batch.column("text")):
                values, counts = shingles(data, offsets)
                keys = [flat.segment_sums(flat.mix64(values + np.uint64(salt)), counts).view(np.int64) for salt in (1, 0x5BD1E995)]
                rows = np.zeros((end - row, TREES * DEPTH), np.uint32)
                if counts.any():
                    rows[counts > 0] = signatures(values, counts)
                size = rows.shape[1] * 4
                raw = pa.Array.from_buffers(pa.binary(), end - row, [
                    None, pa.py_buffer((np.arange(end - row + 1) * size).astype(np.int32).tobytes()), pa.py_buffer(rows.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(row, end - row) for c in TEXT), pa.array(keys[0]), pa.array(keys[1]), pa.array(counts.astype(np.int64)), raw],
                    [*TEXT, *SET, "signature"])

    return docs.select(*text_names(), "text").mapInArrow(
        run, "doc_id bigint, text_hash bigint, text_bytes bigint, key1 bigint, key2 bigint, n_shingles bigint, signature binary")


def tiled(members: DataFrame, group: str, size: str, member: str) -> DataFrame:
    """One row per member and tile of its group: tile_i <= tile_j, and the
    member's own block."""
    blocks = F.ceil(F.col(size) / TILE).cast("int")
    return (
        members.withColumn("block", F.pmod(F.xxhash64(member), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("tile_i", F.least("block", "other")).withColumn("tile_j", F.greatest("block", "other"))
        .drop("other").withColumnRenamed(group, "tile_group")
    )


TILE_KEYS = ["tile_group", "tile_i", "tile_j"]


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest connected index of each of n nodes."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def common_prefixes(labels: np.ndarray) -> np.ndarray:
    """Places that each row of a sorted tree has in common with the next."""
    return np.cumprod(labels[1:] == labels[:-1], axis=1, dtype=np.int64).sum(axis=1)


def matched(labels: np.ndarray, sizes: np.ndarray, bounds: np.ndarray, apart: np.ndarray, near) -> np.ndarray:
    """The smallest connected index of each row of some sorted groups.
    ``apart`` is the block of the rows of a tile of two blocks, else their
    index; ``near(i, j)`` tells which pairs are candidates."""
    n = len(sizes)
    common = common_prefixes(labels)
    common[bounds[1:-1] - 1] = -1
    depth = depths(sizes)
    label = np.arange(n)
    for k in range(DEPTH, int(depth.min(initial=DEPTH)) - 1, -1):
        run = np.flatnonzero(np.concatenate([common < k, [True]])) + 1  # ends of the nodes of the trie
        end = run[np.searchsorted(run, np.arange(n), side="right")]
        at, step = np.arange(n), 1
        left, right = [], []
        while len(at):
            at = at[at + step < end[at]]
            pair = at[(apart[at] != apart[at + step]) & (label[at] != label[at + step])
                      & (np.minimum(depth[at], depth[at + step]) <= k)]
            pair = pair[near(pair, pair + step)]
            left.append(pair)
            right.append(pair + step)
            if not step & (step - 1) or not len(at):  # connect what was found so far
                moved = np.flatnonzero(label != np.arange(n))
                if any(map(len, left)):
                    label = least_labels(n, np.concatenate([*left, moved]), np.concatenate([*right, label[moved]]))
                left, right = [], []
            step += 1
    return label


def _candidate_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, TILE_KEYS):
        bounds = group_bounds(key_rows(table, TILE_KEYS))
        n = table.num_rows
        ids = table.column("rep").to_numpy()
        across = table.column("tile_i").to_numpy() != table.column("tile_j").to_numpy()
        apart = np.where(across, table.column("block").to_numpy(), np.arange(n))
        rows = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(n, -1)
        labels = np.frombuffer(b"".join(table.column("label").to_pylist()), np.uint32).reshape(n, -1)
        near = lambda i, j: (rows[i] == rows[j]).mean(axis=1) >= LEAST  # noqa: E731, B023
        label = matched(labels, table.column("n_shingles").to_numpy(), bounds, apart, near)
        moved = np.flatnonzero(label != np.arange(n))
        yield pa.RecordBatch.from_pydict({"a": pa.array(ids[moved]), "b": pa.array(ids[label[moved]])})


def common_counts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many shingles each two of some sets have in common."""
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    _, column, seen = np.unique(values, return_inverse=True, return_counts=True)
    shared = seen > 1  # of a shingle that one set has, nothing is common
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    total = np.zeros((n, n), np.float64)
    width = max(1, (1 << 20) // n)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, TILE_KEYS):
        bounds = group_bounds(key_rows(table, TILE_KEYS))
        ids, sizes = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        block = table.column("block").to_numpy()
        across = table.column("tile_i").to_numpy() != table.column("tile_j").to_numpy()
        links, root = np.zeros(len(ids), np.int64), ids.copy()
        texts = table.column("text").combine_chunks()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            parts = [shingles(d, o) for _, _, d, o in flat.text_slices(texts.slice(a, b - a))]
            counts = np.concatenate([p[1] for p in parts])
            common = common_counts(np.concatenate([p[0] for p in parts]), counts)
            union = counts[:, None] + counts[None, :] - common
            linked = (THRESHOLD.denominator * common >= THRESHOLD.numerator * union) & (union > 0)
            np.fill_diagonal(linked, False)
            if across[a]:
                linked &= block[a:b, None] != block[None, a:b]
            links[a:b] = linked @ sizes[a:b]
            root[a:b] = ids[a:b][least_labels(b - a, *np.nonzero(linked))]
        yield pa.RecordBatch.from_pydict({"rep": pa.array(ids), "links": pa.array(links), "root": pa.array(root)})


def _by_tile(rows: DataFrame, *order: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *TILE_KEYS).sortWithinPartitions(*TILE_KEYS, *order)


def classified(docs: DataFrame) -> DataFrame:
    """One row per document: names of its text, rep_id and copies of its
    shingle set, root (number of its group of linked sets) and links (null
    for a set without any)."""
    sketch = materialize(sketches(docs), "forest-sketches")
    worded = sketch.filter("n_shingles > 0")
    sets = worded.groupBy(*SET).agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"))
    # written once, so that the number of a set is the same for every reader
    sets = materialize(sets.withColumn("rep", F.monotonically_increasing_id()), "forest-sets")
    known = worded.filter(F.col("n_shingles") >= FEWEST).join(sets, SET).filter(F.col("doc_id").eqNullSafe(F.col("rep_id")))
    reps = materialize(known.select("rep", "copies", *TEXT, "n_shingles", "signature").dropDuplicates(["rep"]), "forest-reps")

    # forest: the nodes of each tree at the shortest prefix, sorted within
    shortest = int(_DEPTHS[FEWEST:].min())
    label = lambda t, k: F.substring("signature", t * DEPTH * 4 + 1, k * 4)
    nodes = F.array(*[F.struct(F.xxhash64(F.lit(t), label(t, shortest)).alias("node"), label(t, DEPTH).alias("label")) for t in range(TREES)])
    leaves = reps.select("rep", F.inline(nodes))
    shared = leaves.groupBy("node").agg(F.count(F.lit(1)).alias("width")).filter("width > 1")
    placed = leaves.join(shared, "node").join(reps.select("rep", "n_shingles", "signature"), "rep")
    tiles = tiled(placed, "node", "width", "rep").select(*TILE_KEYS, "block", "rep", "n_shingles", "signature", "label")
    groups = components(_by_tile(tiles, "label", "rep").mapInArrow(_candidate_edges, "a bigint, b bigint"))

    # verification of each group of candidates
    everyone = groups.select(F.col("id").alias("rep"), "root").unionByName(
        groups.select(F.col("root").alias("rep"), "root").distinct())
    width = groups.groupBy("root").agg((F.count(F.lit(1)) + 1).alias("width"))
    members = materialize(everyone.join(width, "root").join(reps.select("rep", "copies", *TEXT), "rep"), "forest-members")
    texts = docs.select(*text_names(), "text")
    # one plan at every size: the texts are shuffled once by their names
    bodies = texts.join(members.hint("merge"), same(texts, members, TEXT)).select("rep", "root", "width", "copies", "text").dropDuplicates(["rep"])
    tiles = tiled(bodies, "root", "width", "rep").select(*TILE_KEYS, "block", "rep", "copies", "text")
    verified = materialize(_by_tile(tiles, "rep").mapInArrow(_verified, "rep bigint, links bigint, root bigint"), "forest-links")
    final = components(verified.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("rep").agg(F.sum("links").alias("links"))
    result = sets.join(links, "rep", "left").join(final.withColumnRenamed("id", "rep"), "rep", "left").select(
        *SET, "rep_id", "copies", F.coalesce("root", "rep").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    return sketch.drop("signature").join(result, SET, "left")


def join_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its group of
    linked texts), rep_id (smallest id with the same shingle set), n_links
    (other documents with a similarity of at least the threshold)."""
    rows = materialize(classified(docs), "forest-classes")
    named = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("rep_id").alias("class_id"))
    lone = F.col("root").isNull()
    return rows.join(named, "root", "left").select(
        "doc_id", F.when(lone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(lone, F.col("doc_id")).otherwise(F.col("rep_id")).alias("rep_id"),
        F.when(lone, 0).otherwise(F.col("copies") - 1 + F.col("links")).cast("bigint").alias("n_links"), "n_shingles")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group of linked
    texts (null ids last; of several texts under that id, the one of the
    smallest hash). Rows equal in id and text stay or go together; texts
    without words stay."""
    rows = materialize(classified(docs).filter("root IS NOT NULL").select("root", *TEXT).distinct(), "forest-classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), *TEXT)
    kept = rows.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    gone = rows.join(kept, "root").filter(~F.struct(F.col("doc_id").isNull().alias("none"), *TEXT).eqNullSafe(F.col("first"))).select(*TEXT)
    names = free_names(docs.columns, *TEXT[1:])
    gone = gone.toDF("doc_id", *names)
    named = docs.withColumns({n: c for n, c in zip(names, text_names()[1:], strict=True)})
    test = named["doc_id"].cast("bigint").eqNullSafe(gone["doc_id"]) & same(named, gone, names)
    return named.join(gone, test, "left_anti").select(*docs.columns)
