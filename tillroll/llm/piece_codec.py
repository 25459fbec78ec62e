"""SentencePiece encoding and decoding by vectorised merge rounds.

Texts become one flat array of symbols. A round finds, for each word, the
pair of neighbours with the best rank (the leftmost of equals), merges it
in all words at once and compacts the array; words without a known pair
leave. Pieces never hold a space mark after another character (checked on
load), so no merge crosses from a word into the next space mark and words
are independent of each other; equal words of a slice are merged once.

A merge may open a pair of better rank than the one just merged, so a
word takes one merge per round: that is the order of the library. Words
longer than ``LONG_WORD`` characters (mostly runs of one character) would
need as many rounds; they take their merges from a heap instead, in the
same order.

Models: BPE with byte fallback, identity normalisation, a dummy prefix
and escaped, unmerged spaces. Others raise ValueError.

Cases: a null or empty text has no ids and decodes to the empty text; a
space mark in a text decodes to a space, as in the library; ids outside
the vocabulary raise; bytes that are not UTF-8 decode to U+FFFD each.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import flat

MARK = "▁"  # stands for a space
NORMAL, UNKNOWN, BYTE = 1, 2, 6  # piece types of the model file that matter here
LONG_WORD = 256
SLICE_BYTES = 1 << 20  # text worked on at once: some 100 bytes of arrays for each of its own
_NONE = np.int32(2**31 - 1)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, raw[at : at + size]
        at += size


class PieceModel:
    """Tables of a model file: character ids, pair merges, piece bytes."""

    def __init__(self, raw: bytes):
        pieces: list[str] = []
        scores: list[float] = []
        kinds: list[int] = []
        spec: dict[int, int | bytes] = {}
        trainer: dict[int, int | bytes] = {}
        for field, value in _fields(raw):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                spec = dict(_fields(value))
        plain = spec.get(2, b"") == b"" and spec.get(3, 1) == 1 and spec.get(4, 1) == 0 and spec.get(5, 1) == 1
        if trainer.get(3) != 2 or trainer.get(35) != 1 or not plain:
            raise ValueError("only BPE models with byte fallback and identity normalisation")
        if not set(kinds) <= {NORMAL, UNKNOWN, 3, BYTE}:
            raise ValueError("models with user-defined or unused pieces are not supported")
        index = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in index):
            raise ValueError("a piece holds a space mark after another character")
        self.size = len(pieces)
        self.byte_ids = np.zeros(256, np.int32)
        for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)):
            if k == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in index.values()}, reverse=True))}
        rank = {i: order[scores[i]] for i in index.values()}
        # characters: symbol id by code point; unknown ones get ids beyond the vocabulary
        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in index.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        # every way to put two pieces together
        left, right, into = [], [], []
        for p, i in index.items():
            for cut in range(1, len(p)):
                a, b = index.get(p[:cut]), index.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    into.append(i)
        self._hash_pairs(np.array(left, np.int64), np.array(right, np.int64), np.array(into, np.int32),
                         np.array([rank[i] for i in into], np.int32))
        # what a piece decodes to
        text = [b"" if k not in (NORMAL, BYTE) else bytes([int(p[3:5], 16)]) if k == BYTE
                else p.replace(MARK, " ").encode() for p, k in zip(pieces, kinds, strict=True)]
        for i, k in enumerate(kinds):
            if k == UNKNOWN:
                text[i] = trainer.get(44, b" \xe2\x81\x87 ")
        self.piece_bytes = np.frombuffer(b"".join(text), np.uint8)
        self.piece_lengths = np.array([len(t) for t in text], np.int64)
        self.piece_starts = np.cumsum(self.piece_lengths) - self.piece_lengths
        self.marked = np.array([k == NORMAL and p.startswith(MARK) for p, k in zip(pieces, kinds, strict=True)])

    def _hash_pairs(self, left: np.ndarray, right: np.ndarray, into: np.ndarray, rank: np.ndarray) -> None:
        """An open hash table; entries that share a slot move on by one."""
        bits = 16
        while (1 << bits) < 4 * len(left):
            bits += 1
        self._bits = np.uint64(64 - bits)
        self._slots = (1 << bits) + 64
        self._keys = np.full(self._slots, -1, np.int64)
        self._into = np.zeros(self._slots, np.int32)
        self._rank = np.full(self._slots, _NONE, np.int32)
        self._steps = 1
        for key, i, r in zip(((left << 32) | right).tolist(), into.tolist(), rank.tolist(), strict=True):
            slot = ((key * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> (64 - bits)
            steps = 1
            while self._keys[slot] != -1:
                slot += 1
                steps += 1
            self._keys[slot], self._into[slot], self._rank[slot] = key, i, r
            self._steps = max(self._steps, steps)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; rank ``_NONE``: no such piece."""
        key = (left.astype(np.int64) << 32) | right
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._bits).astype(np.int64)
        found = self._keys[slot] == key
        rank = np.where(found, self._rank[slot], _NONE)
        into = self._into[slot]
        open_ = np.flatnonzero(~found & (self._keys[slot] != -1))
        for _ in range(self._steps - 1):
            if not len(open_):
                break
            slot[open_] += 1
            at = slot[open_]
            hit = self._keys[at] == key[open_]
            rank[open_[hit]] = self._rank[at[hit]]
            into[open_[hit]] = self._into[at[hit]]
            open_ = open_[~hit & (self._keys[at] != -1)]
        return rank, into

    # --- encoding ------------------------------------------------------------

    def merge_words(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge each word to its final symbols; returns them flat with the
        new lengths. Words are non-empty."""
        done_word: list[np.ndarray] = []
        done_symbols: list[np.ndarray] = []
        done_lengths: list[np.ndarray] = []
        word = np.arange(len(lengths))
        long_ = np.flatnonzero(lengths > LONG_WORD)
        if len(long_):
            before = np.cumsum(lengths) - lengths
            for w in long_:
                merged = self._merge_by_heap(symbols[before[w] : before[w] + lengths[w]])
                done_word.append(np.array([w]))
                done_symbols.append(merged)
                done_lengths.append(np.array([len(merged)]))
            keep = lengths <= LONG_WORD
            symbols = symbols[np.repeat(keep, lengths)]
            word, lengths = word[keep], lengths[keep]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        rank, into = self._ranks(symbols, owner)
        while len(lengths):
            before = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(rank, before)
            over = best == _NONE
            if over.any():
                out = over[owner]
                done_word.append(word[over])
                done_symbols.append(symbols[out])
                done_lengths.append(lengths[over])
                keep = ~out
                symbols, rank, into = symbols[keep], rank[keep], into[keep]
                word, lengths, best = word[~over], lengths[~over], best[~over]
                owner = np.repeat(np.arange(len(lengths)), lengths)
                if not len(lengths):
                    break
                before = np.cumsum(lengths) - lengths
            # the leftmost place of each word that has its best rank
            places = np.flatnonzero(rank == best[owner])
            places = places[np.concatenate([[True], owner[places[1:]] != owner[places[:-1]]])]
            symbols[places] = into[places]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            moved = places - np.arange(len(places))  # where the merged symbols are afterwards
            symbols, rank, into, owner = symbols[keep], rank[keep], into[keep], owner[keep]
            lengths = lengths - 1
            # the pairs on both sides of a merged symbol are new
            touched = np.concatenate([moved, moved[moved > 0] - 1])
            rank[touched] = _NONE
            touched = touched[touched + 1 < len(symbols)]
            touched = touched[owner[touched] == owner[touched + 1]]
            rank[touched], into[touched] = self.pairs(symbols[touched], symbols[touched + 1])
        if not done_word:
            return symbols, lengths
        word = np.concatenate(done_word)
        flat_symbols = np.concatenate(done_symbols)
        flat_lengths = np.concatenate(done_lengths)
        before = np.cumsum(flat_lengths) - flat_lengths
        order = np.argsort(word, kind="stable")
        return flat_symbols[flat.positions(before[order], flat_lengths[order])], flat_lengths[order]

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merge of each symbol with the next one of its word."""
        rank = np.full(len(symbols), _NONE, np.int32)
        into = np.zeros(len(symbols), np.int32)
        at = np.flatnonzero(owner[1:] == owner[:-1])
        rank[at], into[at] = self.pairs(symbols[at], symbols[at + 1])
        return rank, into

    def _merge_by_heap(self, symbols: np.ndarray) -> np.ndarray:
        """The same merges of one long word, best rank first, then leftmost."""
        ids = symbols.tolist()
        n = len(ids)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, into = self._ranks(symbols, np.zeros(n, np.int64))
        heap = [(int(rank[i]), i, ids[i], ids[i + 1], int(into[i])) for i in np.flatnonzero(rank != _NONE).tolist()]
        heapq.heapify(heap)
        known: dict[tuple[int, int], tuple[int, int]] = {}
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = merged, -1
            after[i] = after[j]
            if after[j] < n:
                prior[after[j]] = i
            for p, q in ((prior[i], i), (i, after[i])):
                if p >= 0 and q < n:
                    pair = (ids[p], ids[q])
                    if pair not in known:
                        r, m = self.pairs(np.array([pair[0]]), np.array([pair[1]]))
                        known[pair] = (int(r[0]), int(m[0]))
                    r, m = known[pair]
                    if r != _NONE:
                        heapq.heappush(heap, (r, p, pair[0], pair[1], m))
        return np.array([i for i in ids if i != -1], np.int32)

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each text."""
        n = len(offsets) - 1
        # the escaped text: a mark before each text and for each space
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        heads = np.concatenate([[0], np.cumsum(~flat.CONTINUATION[data])])
        at = heads[offsets]  # in code points
        full = np.flatnonzero(at[1:] > at[:-1])
        points = np.insert(points, at[:-1][full], ord(" "))
        at = at + np.concatenate([[0], np.cumsum(at[1:] > at[:-1])])
        points = np.where(points == 32, np.uint32(ord(MARK)), points)
        mark = points == ord(MARK)
        # words begin at marks that no mark precedes, and at each text
        first = mark.copy()
        first[1:] &= ~mark[:-1]
        first[at[:-1][full]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(points))
        hashes = self._word_hashes(points, starts, ends)
        _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        lengths = (ends - starts)[sample]
        chars = points[flat.positions(starts[sample], lengths)]
        symbols = self.char_ids[chars]
        # characters outside the vocabulary stay alone; their ids lie beyond it
        symbols = np.where(symbols < 0, chars.astype(np.int32) + self.size, symbols)
        ids, lengths = self.merge_words(symbols, lengths)
        ids, lengths = self._fall_back(ids, lengths)
        before = np.cumsum(lengths) - lengths
        counts = lengths[which]
        flat_ids = ids[flat.positions(before[which], counts)]
        per_text = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, at)]
        return flat_ids, np.diff(per_text)

    @staticmethod
    def _word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = points.astype(np.uint64)
        values = flat.mix64(raw + np.uint64(0x5851F42D4C957F2D))
        inner = np.arange(len(points)) - np.repeat(starts, ends - starts)
        longest = int((ends - starts).max())
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest - 1, np.uint64(0x9E3779B97F4A7C15))])
                            .astype(np.uint64))
        return flat.mix64(np.add.reduceat(values * powers[inner], starts) + (ends - starts).astype(np.uint64))

    def _fall_back(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Write characters outside the vocabulary as the ids of their bytes."""
        strange = np.flatnonzero(ids >= self.size)
        if not len(strange):
            return ids, lengths
        points = (ids[strange] - self.size).astype(np.uint32)
        raw = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        width = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
        copies = np.ones(len(ids), np.int64)
        copies[strange] = width
        word = np.repeat(np.arange(len(lengths)), lengths)
        out = np.repeat(ids, copies)
        out[np.repeat(ids >= self.size, copies)] = self.byte_ids[raw]
        return out, np.bincount(np.repeat(word, copies), minlength=len(lengths))

    # --- decoding ------------------------------------------------------------

    def decode_flat(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of the id lists ``ids[offsets[i]:offsets[i + 1]]``."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id lies outside the vocabulary")
        lengths = self.piece_lengths[ids]
        pieces = self.piece_bytes[flat.positions(self.piece_starts[ids], lengths)]
        # the first piece of a text loses the space of the dummy prefix
        heads = offsets[:-1][offsets[1:] > offsets[:-1]]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        keep = np.ones(len(pieces), bool)
        keep[ends[heads[self.marked[ids[heads]]]]] = False
        text_at = np.concatenate([[0], np.cumsum(keep)])[ends[offsets]]
        pieces = pieces[keep]
        try:
            pieces.tobytes().decode()
        except UnicodeDecodeError:
            return pa.array([_replaced(pieces[a:b].tobytes()) for a, b in zip(text_at[:-1], text_at[1:], strict=True)],
                            pa.string())
        return flat.text_array(pieces, text_at)


def _replaced(raw: bytes) -> str:
    """UTF-8 text with U+FFFD for every byte that belongs to no character."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[: e.start].decode() + "�")
            raw = raw[e.start + 1 :]
    return "".join(out)


def load_model(path: str) -> bytes:
    """The bytes of a model file (0.5 MB for 32,000 pieces)."""
    with open(path, "rb") as f:
        return f.read()


def _shared_model(spark, raw: bytes):
    """The model's tables (about 10 MB) as a broadcast."""
    return spark.sparkContext.broadcast(vars(PieceModel(raw)))


def _from_tables(tables: dict) -> PieceModel:
    model = object.__new__(PieceModel)
    vars(model).update(tables)
    return model


def encode(docs: DataFrame, raw_model: bytes, id_col: str = "doc_id", text_col: str = "text",
           with_decoded: bool = False) -> DataFrame:
    """(id, ids array<int>): the ids of every whole text; on request with
    the text that they decode to, in the same pass."""
    tables = _shared_model(docs.sparkSession, raw_model)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           *([T.StructField("decoded", T.StringType())] if with_decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _from_tables(tables.value)
        for batch in batches:
            for row, end, data, offsets in flat.text_slices(batch.column("text"), SLICE_BYTES):
                ids, counts = model.encode_slice(data, offsets)
                at = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32, copy=False)))
                columns = [batch.column("id").slice(row, end - row), lists]
                if with_decoded:
                    columns.append(model.decode_flat(ids, at))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, raw_model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null ids decode to the empty text."""
    tables = _shared_model(encoded.sparkSession, raw_model)
    schema = T.StructType([*(f for f in encoded.schema.fields if f.name != text_col),
                           T.StructField(text_col, T.StringType())])
    keep = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _from_tables(tables.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(ids_col)
            counts = np.array(lists.value_lengths().fill_null(0), np.int64)
            ids = np.asarray(lists.flatten(), np.int64)
            texts = model.decode_flat(ids, np.concatenate([[0], np.cumsum(counts)]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), texts], [*keep, text_col])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, raw_model: bytes) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return encode(docs, raw_model, with_decoded=True).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
