"""Token files: the ids of every document as Parquet list columns.

Documents are dealt out by ranges of doc_id and sorted, then encoded in that
order, so the files follow one another in ascending doc_id. A row holds

* ``doc_id``, ``part`` (number of its file), ``first`` (ids of the part
  before it) and ``n_tokens``: delta-encoded, a few bytes a document;
* ``ids``: a list of ints, dictionary-encoded, so an id takes the bits that
  the vocabulary of its row group needs.

Row groups, pages and rows in a page are bounded by parameters, and every
column chunk has its page index. A reader of metadata fetches no ids, a
reader of some documents or of a span of the token stream only the pages
that hold them. A small table beside the files tells rows, ids, first and
last doc_id of each part and the ids of all parts before it.

Encoding is that of the tokenizers library. No token crosses ASCII white
space, nor the border between an ASCII letter, an ASCII digit and other
ASCII signs but the apostrophe, nor two digits (checked for the tokenizer
file on load), and A-Z are lowered. So a slice of texts is lowered, cut there
into pieces in numpy, and each distinct piece is encoded once by the library.
Texts that may hold a special token are cut at white space only. Pieces of
one word are handed over many at a time; their ids part after each id that
ends a word. A piece without a cut goes to the library as it is, of any
length. A Python worker keeps up to ``CACHE_WORDS`` pieces, whole (as two
64-bit words, longer ones as bytes), from task to task.

Cases: a null or empty text has the end id only; rows of equal doc_id are in
the order of the hash of their text, null ids come last; repeated rows are
documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm import flat

END_ID = 1
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 512
DICTIONARY_BYTES = 1 << 20  # 2^18 ids of four bytes
CACHE_WORDS = 500_000
CACHE_BYTES = 16 << 20  # of pieces longer than 16 bytes
TABLE_BITS = 20
NEW_AT_ONCE = 2000
SLICE_BYTES = 512 << 10  # text worked on at once

DATA_SCHEMA = "doc_id bigint, part int, first bigint, n_tokens bigint, ids array<int>"
COUNTERS = ("doc_id", "part", "first", "n_tokens")

# classes of bytes: 0 white space, apostrophe and all beyond ASCII; 1 letters, 2 digits, 3 other signs
CLASS = np.zeros(256, np.uint8)
CLASS[ord("a") : ord("z") + 1] = 1
CLASS[ord("0") : ord("9") + 1] = 2
CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and b != ord("'")]] = 3
# may a text be cut between a byte of one class and one of the next (4 a + b)?
CUT = np.array([a and b and (a != b or a == 2) for a in range(4) for b in range(4)], bool)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SPECIAL = b"<|"  # begins every special token
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)  # the first n of 8 bytes


def load_tokenizer(path: str) -> str:
    """The JSON text of a tokenizer whose tokens keep to the cuts."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    spec = json.loads(text)
    splits = [s for s in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if s["type"] == "Split"]
    words = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d", r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"}
    cut = any(s["behavior"] == "Removed" and s["invert"] and set(s["pattern"].get("Regex", "").split("|")) == words for s in splits)
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    special = all(t["content"].startswith(SPECIAL.decode()) and not t["normalized"] for t in spec["added_tokens"])
    ends = spec["model"].get("end_of_word_suffix")
    if not (cut and steps == ["NFC", "Replace", "Lowercase"] and special and ends and spec["post_processor"] is None):
        raise ValueError("only tokenizers that lower the text, drop white space and split words from digits and signs")
    return text


class PieceTable:
    """Numbers of pieces of up to 16 bytes, kept whole as two 64-bit words
    and their length in an open hash table."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        slots = (1 << bits) + 4096  # the last ones move on into the rest
        self.left, self.right = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.size = np.zeros(slots, np.uint8)  # 0: empty
        self.number = np.zeros(slots, np.int32)

    def _slots(self, left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
        mixed = flat.mix64(left ^ flat.mix64(right + size.astype(np.uint64)))
        return (mixed >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number of each piece, or -1."""
        out = np.full(len(left), -1, np.int64)
        slot, open_ = self._slots(left, right, size), np.arange(len(left))
        while len(open_):
            held = self.size[slot]
            found = (held == size[open_]) & (self.left[slot] == left[open_]) & (self.right[slot] == right[open_])
            out[open_[found]] = self.number[slot[found]]
            on = ~found & (held > 0)
            open_, slot = open_[on], slot[on] + 1
        return out

    def add(self, left: np.ndarray, right: np.ndarray, size: np.ndarray, number: np.ndarray) -> None:
        """Put in distinct pieces that are not in the table."""
        slot, todo = self._slots(left, right, size), np.arange(len(left))
        while len(todo):
            free = np.flatnonzero(self.size[slot] == 0)
            at, first = np.unique(slot[free], return_index=True)
            put = todo[free[first]]
            self.left[at], self.right[at], self.size[at], self.number[at] = left[put], right[put], size[put], number[put]
            on = np.ones(len(todo), bool)
            on[free[first]] = False
            todo, slot = todo[on], slot[on]
            slot = slot + (self.size[slot] > 0)


class PieceIds:
    """Ids of pieces, each encoded once."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task is the unit of parallel work
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(spec)
        self.whole = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        # the same merges for words that need no other step
        self.merges_only = None, pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = json.loads(spec)["model"]["end_of_word_suffix"]
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends_word[[i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True
        self.forget()

    @staticmethod
    def of_process(spec: str) -> PieceIds:
        """The one of this Python worker: Spark uses a worker for many tasks,
        but unpickles this module for each, so it is kept beside the modules."""
        kept = sys.modules.setdefault("_kept_piece_ids", types.ModuleType("_kept_piece_ids"))
        if getattr(kept, "spec", None) != spec:
            kept.spec, kept.encoder = spec, PieceIds(spec)
        return kept.encoder

    def forget(self) -> None:
        self.table = PieceTable(TABLE_BITS)
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self.known = 0
        self.ids, self.ends = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)

    def _words(self, texts: list[str]) -> tuple[list[int], np.ndarray] | None:
        """Ids and their numbers, if each text is one word."""
        ids = self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids
        ends = np.flatnonzero(self.ends_word[ids])
        return (ids, np.diff(ends, prepend=-1)) if len(ends) == len(texts) else None

    def _each(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [i for ids in found for i in ids], np.array([len(ids) for ids in found], np.int64)

    def _learn(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Encode new pieces by the library; their numbers."""
        raw = low.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        kinds = CLASS[low[flat.positions(starts, ends - starts)]]
        before = np.cumsum(ends - starts) - (ends - starts)
        least, most = np.minimum.reduceat(kinds, before), np.maximum.reduceat(kinds, before)
        plain = (least == most) & (least > 0) & ((least != 2) | (ends - starts == 1))
        letters = ~plain & np.fromiter((t.isalpha() for t in texts), bool, len(texts))
        numbers = np.zeros(len(texts), np.int64)
        others = ~plain & ~letters
        for chosen, steps in ((plain, self.merges_only), (letters, self.whole), (others, self.whole)):
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = steps
            at = np.flatnonzero(chosen)
            for some in (at[k : k + NEW_AT_ONCE] for k in range(0, len(at), NEW_AT_ONCE)):
                own = [texts[k] for k in some]
                found = None if chosen is others else self._words(own)
                numbers[some] = self._keep(*(found or self._each(own)))
        return numbers

    def _keep(self, ids: list[int], counts: np.ndarray) -> np.ndarray:
        first, held = self.known, int(self.ends[self.known])
        while held + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(counts) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[held : held + len(ids)] = ids
        self.known = first + len(counts)
        self.ends[first + 1 : self.known + 1] = held + np.cumsum(counts)
        return np.arange(first, self.known)

    def encode(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all pieces one after another, and how many each has."""
        if self.known > CACHE_WORDS or self.long_bytes > CACHE_BYTES:
            self.forget()
        sizes = ends - starts
        number = np.zeros(len(starts), np.int64)
        short = sizes <= 16
        number[short] = self._short(low, starts[short], ends[short])
        number[~short] = self._long(low, starts[~short], ends[~short])
        begins = self.ends[number]
        counts = self.ends[number + 1] - begins
        return self.ids[flat.positions(begins, counts)], counts

    def _short(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        padded = np.concatenate([low, np.zeros(16, np.uint8)])
        words = np.ndarray(len(low) + 9, np.dtype("<u8"), padded, 0, (1,))  # the 8 bytes from each place on
        sizes = (ends - starts).astype(np.uint8)
        left = words[starts] & MASKS[np.minimum(sizes, 8)]
        right = words[starts + 8 * (sizes > 8)] & MASKS[np.where(sizes > 8, sizes - 8, 0)]
        number = self.table.find(left, right, sizes)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            keys = np.stack([left[missing], right[missing], sizes[missing].astype(np.uint64)])
            order = np.lexsort(keys)
            new = np.concatenate([[True], (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)])
            first = missing[order[new]]
            learned = self._learn(low, starts[first], ends[first])
            self.table.add(left[first], right[first], sizes[first], learned)
            number[missing[order]] = learned[np.cumsum(new) - 1]
        return number

    def _long(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        pieces = [low[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        new: dict[bytes, int] = {}
        for k, piece in enumerate(pieces):
            if piece not in self.long:
                new.setdefault(piece, k)
        if new:
            at = np.fromiter(new.values(), np.int64, len(new))
            self.long.update(zip(new, self._learn(low, starts[at], ends[at]).tolist(), strict=True))
            self.long_bytes += sum(map(len, new))
        return np.fromiter(map(self.long.__getitem__, pieces), np.int64, len(pieces))


def cut_texts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lowered bytes of a slice, and the starts and ends of the pieces."""
    low = LOWER[data]
    kinds = CLASS[low]
    parted = np.ones(len(low) + 1, bool)  # between bytes k - 1 and k
    parted[1:-1] = CUT[kinds[:-1] * 4 + kinds[1:]]
    raw = data.tobytes()
    if SPECIAL in raw:
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if SPECIAL in raw[a:b]:
                parted[a:b], low[a:b] = False, data[a:b]
    blank = flat.SPACE[low]
    parted[offsets] = True
    parted[:-1] |= blank
    parted[1:] |= blank
    at = np.flatnonzero(parted)
    filled = ~blank[at[:-1]]
    return low, at[:-1][filled], at[1:][filled]


def encode_slice(encoder: PieceIds, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a slice, each with the end id, and the number
    of each."""
    low, starts, ends = cut_texts(data, offsets)
    ids, lengths = encoder.encode(low, starts, ends)
    before = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, offsets)]
    return np.insert(ids, before[1:], np.int32(end_id)), np.diff(before) + 1


def encoded(docs: DataFrame, spec: str, end_id: int = END_ID) -> DataFrame:
    """Documents in the order of the files, with their ids."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = PieceIds.of_process(shared.value), 0
        for batch in batches:
            for row, end, data, offsets in flat.text_slices(batch.column(2), SLICE_BYTES):
                ids, n_tokens = encode_slice(encoder, data, offsets, end_id)
                ends = np.cumsum(n_tokens)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                yield pa.record_batch(
                    [batch.column(0)[row:end], batch.column(1)[row:end], pa.array(first + ends - n_tokens),
                     pa.array(n_tokens), lists],
                    names=["doc_id", "part", "first", "n_tokens", "ids"],
                )
                first += int(ends[-1])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    # rows of one doc_id, and copies among them, are split between ranges too
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("hash"), F.col("row")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select("doc_id", F.spark_partition_id().alias("part"), "text").mapInArrow(encode, DATA_SCHEMA)


class TokenFiles:
    """A written token folder; every reader fetches what it needs only."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @property
    def data(self) -> DataFrame:
        return self.spark.read.schema(DATA_SCHEMA).parquet(f"{self.path}/data")

    @property
    def parts(self) -> DataFrame:
        """part, docs, tokens, least and largest doc_id, start."""
        return self.spark.read.parquet(f"{self.path}/parts")

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows of the files with their start in the whole stream."""
        starts = self.parts.select("part", F.col("start").alias("part_start"))
        placed = rows.join(starts, "part").withColumn("start", F.col("part_start") + F.col("first"))
        return placed.drop("part_start", "part", "first")

    def metadata(self) -> DataFrame:
        """doc_id, start, n_tokens of every document; no ids are read."""
        return self.placed(self.data.select(*COUNTERS)).select("doc_id", "start", "n_tokens")

    def documents(self, least: int | None = None, largest: int | None = None) -> DataFrame:
        """doc_id, start, n_tokens, ids, of all documents or those between
        two ids: other files, row groups and pages are skipped."""
        rows = self.data
        if least is not None:
            rows = rows.filter(F.col("doc_id") >= least)
        if largest is not None:
            rows = rows.filter(F.col("doc_id") <= largest)
        return self.placed(rows).select("doc_id", "start", "n_tokens", "ids")

    def span(self, start: int, end: int) -> DataFrame:
        """The ids start .. end - 1 of the token stream, by document."""
        met = self.parts.filter((F.col("start") < end) & (F.col("start") + F.col("tokens") > start))
        rows = self.data.join(met.select("part", F.col("start").alias("part_start")), "part")
        rows = rows.withColumn("start", F.col("part_start") + F.col("first"))
        rows = rows.filter((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > start))
        skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0)).cast("int")
        taken = (F.least(F.lit(end) - F.col("start"), F.col("n_tokens")) - skip).cast("int")
        return rows.select("doc_id", (F.col("start") + skip).alias("start"), F.slice("ids", skip + 1, taken).alias("ids"))


def write_token_files(docs: DataFrame, path: str, spec: str, end_id: int = END_ID) -> TokenFiles:
    """Encode ``docs`` and write them under ``path``."""
    writer = (
        encoded(docs, spec, end_id).write.mode("overwrite")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.dictionary.page.size", DICTIONARY_BYTES)
        .option("parquet.enable.dictionary", "true")
    )
    for column in COUNTERS:
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(f"{path}/data")
    files = TokenFiles(docs.sparkSession, path)
    parts = files.data.groupBy("part").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"),
        F.min("doc_id").alias("least"), F.max("doc_id").alias("largest"),
    )
    # one row per file
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).write.mode("overwrite").parquet(f"{path}/parts")
    return files


def digests(files: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian
    32-bit integers, from the files."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            ids = memoryview(pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype("<i4", copy=False))
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).tolist()
            crc = [zlib.crc32(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=False)]
            yield pa.record_batch([*batch.columns[:4], pa.array(crc, pa.int64())], names=[*COUNTERS, "ids_crc32"])

    # the ids end here: only a few bytes a document meet the table of parts
    rows = files.data.mapInArrow(digest, "doc_id bigint, part int, first bigint, n_tokens bigint, ids_crc32 bigint")
    return files.placed(rows).select("doc_id", "start", "n_tokens", "ids_crc32")
