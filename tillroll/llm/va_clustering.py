"""Centroid clustering over a vector approximation file (VA-file).

Each kept vector is stored twice in one table of the shared folder: as
integers, floor(256 x) of each component, and as ``BITS``-bit cells, two
dimensions a byte. The cells of a dimension are cut where a normal
distribution of the mean and deviation of all vectors would give equal
shares; the outer ones reach the least and largest integer that occurs, so
every cell has exact bounds.

For a set of centroids a table tells, for each pair of dimensions and each
of their cell pairs, between which squared distances a vector there lies
from every centroid. 32 look-ups and additions give the interval of a
vector per centroid. Only centroids whose interval begins below the least
upper end can be nearest: a single one decides, else the integers of the
vector are fetched and only those centroids are measured. All arithmetic is
in 64-bit integers and the intervals are exact, so the result is that of a
full search, whatever the cells.

A round is one pass: the tasks send componentwise sums and counts per
centroid (at most K x 64 rows each), the driver holds the K centroids. The
sums need the integers of every vector, so a round reads both columns; what
the cells save is the measuring, not the reading.

Kept are vectors of exactly ``DIMENSIONS`` components, none null, NaN or
infinite. Cases: fewer than K kept vectors are all centroids; an empty
table gives an empty result; repeated rows count each; of equal hashes
(repeated ids) the smaller vector comes first; a null id comes last among
the first centroids and is clustered like any other; centroids without
vectors stay. A component beyond ``LARGEST`` in size raises: its squared
distances do not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize

DIMENSIONS = 64
SCALE = 256
LARGEST = 2**27  # 64 squares of differences up to 2^28 fit 63 bits
CENTROIDS = 40
ROUNDS = 5
BITS = 4
CELLS = 1 << BITS
SLICE_ROWS = 2048

SUMS_SCHEMA = "cluster int, dimension int, n bigint, total bigint"
STATS_SCHEMA = "dimension int, n bigint, total double, squares double, least bigint, largest bigint"
ASSIGNED_SCHEMA = "vec_id bigint, cluster int, distance bigint, candidates int"


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and the integers of every kept vector."""
    x = F.col("embedding")
    whole = (F.size(x) == DIMENSIONS) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def integer(v):
        scaled = F.floor(v * F.lit(float(SCALE)))
        return F.when(F.abs(v) < LARGEST / SCALE, scaled).otherwise(
            F.raise_error(F.concat(F.lit("component too large for exact squared distances: "), v.cast("string"))).cast("bigint")
        ).cast("int")

    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.filter(x.isNotNull() & whole).select("vec_id", F.transform(x, integer).alias("integers"))


def matrix(column: pa.Array) -> np.ndarray:
    """A batch of integer lists as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS).astype(np.int64)


class Cells:
    """Cell borders per dimension, and the bounds of every cell."""

    def __init__(self, stats: list):
        shares = [NormalDist().inv_cdf(j / CELLS) for j in range(1, CELLS)]
        cuts, low, high = [], [], []
        for s in sorted(stats, key=lambda r: r["dimension"]):
            mean = s["total"] / s["n"]
            deviation = max(s["squares"] / s["n"] - mean * mean, 0.0) ** 0.5
            cut = np.clip(np.ceil(mean + deviation * np.array(shares)), s["least"], s["largest"] + 1).astype(np.int64)
            cuts.append(cut)
            low.append(np.concatenate([[s["least"]], cut]))
            high.append(np.concatenate([cut - 1, [s["largest"]]]))
        self.cuts, self.low, self.high = np.array(cuts), np.array(low), np.array(high)

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Cell numbers, two dimensions to a byte."""
        cells = np.empty(vectors.shape, np.uint8)
        for d in range(DIMENSIONS):
            cells[:, d] = np.searchsorted(self.cuts[d], vectors[:, d], side="right")
        return cells[:, 0::2] << BITS | cells[:, 1::2]

    def bounds(self, centroids: np.ndarray) -> np.ndarray:
        """[pair of dimensions, byte, lower ends then upper ends]."""
        to_low = (self.low[:, :, None] - centroids.T[:, None, :])
        to_high = (self.high[:, :, None] - centroids.T[:, None, :])
        nearest = np.maximum(np.maximum(to_low, -to_high), 0) ** 2
        farthest = np.maximum(np.abs(to_low), np.abs(to_high)) ** 2
        ends = np.concatenate([nearest, farthest], axis=2)
        pairs = ends[0::2, :, None, :] + ends[1::2, None, :, :]
        return np.ascontiguousarray(pairs.reshape(DIMENSIONS // 2, CELLS * CELLS, -1))


def nearest(vectors: np.ndarray, packed: np.ndarray, centroids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector and how many had to be considered."""
    k = len(centroids)
    ends = np.zeros((len(packed), 2 * k), np.int64)
    for pair in range(DIMENSIONS // 2):
        ends += bounds[pair][packed[:, pair]]
    possible = ends[:, :k] <= ends[:, k:].min(axis=1)[:, None]
    found = possible.argmax(axis=1)
    candidates = possible.sum(axis=1)
    open_ = np.flatnonzero(candidates > 1)
    if len(open_):
        row, c = np.nonzero(possible[open_])
        gap = vectors[open_[row]] - centroids[c]
        measured = np.full((len(open_), k), np.iinfo(np.int64).max)
        measured[row, c] = np.einsum("ij,ij->i", gap, gap)
        found[open_] = measured.argmin(axis=1)  # the first of equals
    return found, candidates


def dimension_stats(vectors: DataFrame) -> list:
    """Per dimension: number, sum, sum of squares, least and largest."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares, least, largest = 0, 0.0, 0.0, None, None
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                n, total, squares = n + len(x), total + x.sum(axis=0), squares + (x.astype(float) ** 2).sum(axis=0)
                least = x.min(axis=0) if least is None else np.minimum(least, x.min(axis=0))
                largest = x.max(axis=0) if largest is None else np.maximum(largest, x.max(axis=0))
        if n:
            columns = [np.arange(DIMENSIONS, dtype=np.int32), np.full(DIMENSIONS, n), total.astype(float), squares, least, largest]
            yield pa.record_batch([pa.array(c) for c in columns], names=["dimension", "n", "total", "squares", "least", "largest"])

    rows = vectors.select("integers").mapInArrow(partial, STATS_SCHEMA)
    sums = [F.sum(c).alias(c) for c in ("n", "total", "squares")]
    return rows.groupBy("dimension").agg(*sums, F.min("least").alias("least"), F.max("largest").alias("largest")).collect()


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of smallest hash. Only hashes are ordered over all
    rows; the vectors of the k smallest follow."""
    key = F.coalesce(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256), F.lit("none")).alias("key")
    smallest = vectors.select(key).orderBy("key").limit(k).collect()
    if not smallest:
        return np.zeros((0, DIMENSIONS), np.int64)
    rows = vectors.select(key, "integers").filter(F.col("key") <= smallest[-1]["key"])
    return np.array([r["integers"] for r in rows.orderBy("key", "integers").limit(k).collect()], np.int64)


def approximation_file(vectors: DataFrame, cells: Cells) -> DataFrame:
    """vec_id, integers, cells; written to the shared folder."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = cells.encode(matrix(batch.column(1)))
            data = pa.py_buffer(packed.tobytes())
            offsets = pa.py_buffer((np.arange(len(packed) + 1) * packed.shape[1]).astype(np.int32).tobytes())
            column = pa.Array.from_buffers(pa.binary(), len(packed), [None, offsets, data])
            yield pa.record_batch([*batch.columns, column], names=["vec_id", "integers", "cells"])

    coded = vectors.mapInArrow(encode, "vec_id bigint, integers array<int>, cells binary")
    return materialize(coded, "va-file")


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with their integers and packed cells."""
    for at in range(0, batch.num_rows, SLICE_ROWS):
        rows = batch.slice(at, SLICE_ROWS)
        cells = rows.column("cells")
        start = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset]
        packed = np.frombuffer(cells.buffers()[2], np.uint8)[start : start + rows.num_rows * DIMENSIONS // 2]
        yield rows, matrix(rows.column("integers")), packed.reshape(rows.num_rows, -1)


def moved_centroids(table: DataFrame, cells: Cells, centroids: np.ndarray) -> np.ndarray:
    """One round: assign all vectors, then the floored means."""
    k = len(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = cells.bounds(centroids)
        n, total = np.zeros(k, np.int64), np.zeros((k, DIMENSIONS), np.int64)
        for batch in batches:
            for _, vectors, packed in _slices(batch):
                found, _ = nearest(vectors, packed, centroids, bounds)
                order = np.argsort(found, kind="stable")
                which, first = np.unique(found[order], return_index=True)
                total[which] += np.add.reduceat(vectors[order], first, axis=0)
                n += np.bincount(found, minlength=k)
        filled = np.flatnonzero(n)
        if len(filled):
            yield pa.record_batch(
                [pa.array(np.repeat(filled, DIMENSIONS).astype(np.int32)),
                 pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(filled))),
                 pa.array(np.repeat(n[filled], DIMENSIONS)), pa.array(total[filled].ravel())],
                names=["cluster", "dimension", "n", "total"],
            )

    rows = table.select("integers", "cells").mapInArrow(sums, SUMS_SCHEMA)
    new = centroids.copy()
    for r in rows.groupBy("cluster", "dimension").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r["cluster"], r["dimension"]] = r["total"] // r["n"]
    return new


def assigned(table: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, squared distance, and the centroids considered."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = cells.bounds(centroids)
        for batch in batches:
            for part, vectors, packed in _slices(batch):
                found, candidates = nearest(vectors, packed, centroids, bounds)
                gap = vectors - centroids[found]
                yield pa.record_batch(
                    [part.column("vec_id"), pa.array(found.astype(np.int32)), pa.array(np.einsum("ij,ij->i", gap, gap)),
                     pa.array(candidates.astype(np.int32))],
                    names=["vec_id", "cluster", "distance", "candidates"],
                )

    return table.select("vec_id", "integers", "cells").mapInArrow(rows, ASSIGNED_SCHEMA)


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256,
    candidates (centroids whose interval overlapped) per kept vector."""
    spark = embeddings.sparkSession
    vectors = materialize(integer_vectors(embeddings), "va-vectors")
    centroids = first_centroids(vectors, k, seed)
    if len(centroids):
        cells = Cells(dimension_stats(vectors))
        table = approximation_file(vectors, cells)
        for _ in range(rounds):
            centroids = moved_centroids(table, cells, centroids)
        rows = materialize(assigned(table, cells, centroids), "va-assigned")
    else:
        rows = spark.createDataFrame([], ASSIGNED_SCHEMA)
    digests = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids.tolist())]
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia"))
    # one row per centroid on this side: k at most
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string").join(sums, "cluster")
    named = named.withColumn("inertia", total.scalar())
    return rows.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "candidates"
    )
