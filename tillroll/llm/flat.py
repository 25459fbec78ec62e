"""Flat numpy views of Arrow text columns.

A batch of texts is looked at as one run of bytes with document offsets,
so that words, lines and hashes of all its documents come out of a few
array operations. Batches are cut into slices of about ``SLICE_BYTES``
(never inside a document) to bound the memory of a task.

Null texts count as empty. Words are ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def byte_table(chars: bytes) -> np.ndarray:
    """256 booleans: which bytes are among ``chars``."""
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


SPACE = byte_table(b" \t\n\x0b\x0c\r")
NEWLINE = byte_table(b"\n")
CONTINUATION = np.arange(256) >> 6 == 2  # UTF-8 bytes that do not begin a code point

_RNG = np.random.default_rng(20240131)
_BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(32))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into (first row, end row, bytes, offsets)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.string()), "")
    n = len(column)
    buffers = column.buffers()
    if n == 0:
        return
    offsets = np.frombuffer(buffers[1], dtype=np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; no run crosses a
    document boundary."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words and, per document, the index of its
    first word (one more entry than documents)."""
    starts, ends = runs(~SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all \\n-split lines (empty ones included) and,
    per document, the index of its first line."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    # a document's lines begin at its start and after each break, and end
    # at each break and at its end; sorted within a document both pair up
    doc = np.searchsorted(offsets, breaks, side="right") - 1
    owner = np.concatenate([np.arange(len(offsets) - 1), doc])
    starts = starts[np.lexsort((starts, owner))]
    order = np.lexsort((ends, owner))
    return starts, ends[order], np.searchsorted(owner[order], np.arange(len(offsets)))


def positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of all elements of the given pieces, piece by piece."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive pieces of ``values``; empty pieces give 0."""
    out = np.zeros(len(lengths), dtype=values.dtype)
    full = lengths > 0
    if full.any():
        before = np.cumsum(lengths) - lengths
        out[full] = np.add.reduceat(values, before[full])
    return out


def piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte pieces; the same on every machine."""
    lengths = ends - starts
    if len(lengths) == 0:
        return np.zeros(0, np.uint64)
    longest = int(lengths.max())
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(longest - 1, 0), _STEP)]).astype(np.uint64))
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    inner = np.arange(total, dtype=np.int64) - np.repeat(before, lengths)
    values = _BYTE_VALUES[data[inner + np.repeat(starts, lengths)]]
    values *= powers[inner]
    return mix64(segment_sums(values, lengths) + lengths.astype(np.uint64) * _MIX)


def counts_per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the flags are true between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` consecutive entries."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _STEP
        out += hashes[k : k + n]
        out ^= out >> np.uint64(29)
    return mix64(out)


def repeated(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: is its hash found again in its document, and was it
    found earlier there? Entries come in document order."""
    n = len(hashes)
    again, earlier = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        keys = mix64(hashes + doc.astype(np.uint64) * _STEP)
        order = np.argsort(keys, kind="stable")
        same = (keys[order][1:] == keys[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        earlier[order[1:][same]] = True
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
    return again, earlier


def text_array(pieces: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow string column from flat UTF-8 bytes and offsets."""
    return pa.Array.from_buffers(
        pa.string(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(pieces).tobytes())],
    )
