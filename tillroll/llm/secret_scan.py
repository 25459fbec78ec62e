"""Secret scans: fixed patterns and a randomness test battery.

Base spans come from three patterns (``ASSIGN``, ``ACCESS``, ``HEX``) and
always stay. The method adds spans of kind ``random``: runs of at least
``SHORTEST`` characters of ``[A-Za-z0-9+/_=-]`` that touch no base span and

1. pass a battery of tests of randomness over their inferred encoding (the
   smallest alphabet of ``ALPHABETS`` that holds all their characters):
   chi-squared uniformity over the alphabet, the number of runs above and
   below its middle, and the serial correlation of neighbours. The three
   p-values are combined by Fisher's method and must reach ``PASS``;
2. are unlikely as words. A model of neighbouring characters, learned from
   the shorter runs of the corpus and with their ends, gives the likelihood
   of the run, either as it stands or in the folded case, with a share
   of ``CASE_CHANGE`` of the neighbouring letters changing case (capitals,
   joined words). Against a uniform choice from the alphabet (of any length
   n, with a share of 1 / n (n + 1)) it bounds the p-value of "this is a
   word" by Markov's inequality, p(words) / p(uniform). So letters count by
   their neighbours, and no kind of character is asked for. Digits count by
   the length of their run: a number of n digits has a probability of
   10^(-n NUMBER_DECAY) at least, so cards, phones and times are numbers (and
   32 digits are a base span already);
3. stand out when both are combined (the bound over the battery's p-value:
   a run that is hardly random must be the more unlikely as a word) under
   Benjamini-Hochberg control at ``FALSE_SHARE``, done apart for each class
   of length, so that the many short runs do not use up the evidence of the
   long ones and the other way round.

Neighbour counts, the number of tested runs and the thresholds cover the
whole table; they reach the driver as histograms of fixed size.

Cases: a null text counts as empty; an empty text has no spans and its
digest is that of the empty string; repeated rows are scanned each; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import flat
from tillroll.session import materialize

# fixed values of the base patterns
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")

SHORTEST = 16
LENGTH_CLASSES = (16, 20, 24, 32, 48, 64, 128)  # least lengths
PASS = 1e-3
FALSE_SHARE = 0.001
NUMBER_DECAY = 0.25  # decades per digit
CASE_CHANGE = 0.125  # share of neighbouring letters
EVIDENCE_BINS, EVIDENCE_STEP = 400, 0.25  # of -log10 p
DIGITS, CAPITALS, SMALL = b"0123456789", bytes(range(65, 91)), bytes(range(97, 123))
ALPHABETS = (  # from the smallest
    DIGITS, DIGITS + b"abcdef", DIGITS + b"ABCDEF", SMALL, CAPITALS, CAPITALS + b"234567=", DIGITS + SMALL, DIGITS + CAPITALS,
    CAPITALS + SMALL, DIGITS + CAPITALS + SMALL, DIGITS + CAPITALS + SMALL + b"+/=", DIGITS + CAPITALS + SMALL + b"-_=",
    DIGITS + CAPITALS + SMALL + b"+/-_=",
)
_TOKEN = flat.byte_table(ALPHABETS[-1])
_MEMBER = np.stack([flat.byte_table(a) for a in ALPHABETS])
_PLACE = np.zeros((len(ALPHABETS), 256), np.int64)
for _k, _a in enumerate(ALPHABETS):
    _PLACE[_k, list(_a)] = np.arange(len(_a))
_SIZE = np.array([len(a) for a in ALPHABETS], np.float64)
_HEX_BYTE = flat.byte_table(DIGITS + b"abcdef")
_SMALL, _CAPITAL = flat.byte_table(SMALL), flat.byte_table(CAPITALS)
END = len(ALPHABETS[-1])  # stands before and after every run
_SYMBOL = np.full(256, END, np.int64)
_SYMBOL[list(ALPHABETS[-1])] = np.arange(END)
_FOLD = np.arange(END + 1)
_FOLD[_SYMBOL[list(CAPITALS)]] = _SYMBOL[list(SMALL)]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the three patterns, in the order start, kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LENGTH]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# --- the battery -----------------------------------------------------------------


def _normal_tail(z: np.ndarray) -> np.ndarray:
    """Two-sided p-value of a standard normal (Abramowitz-Stegun 7.1.26)."""
    x = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return np.clip(poly * np.exp(-x * x), 1e-30, 1.0)


def _chi_tail(x: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """Upper tail of chi-squared by the Wilson-Hilferty cube root."""
    z = (np.cbrt(x / dof) - (1 - 2 / (9 * dof))) / np.sqrt(2 / (9 * dof))
    two = _normal_tail(z)
    return np.clip(np.where(z > 0, two / 2, 1 - two / 2), 1e-30, 1.0)


def battery(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combined p-value of randomness, and the inferred alphabet, of runs."""
    lengths = ends - starts
    n = lengths.astype(np.float64)
    owner = np.repeat(np.arange(len(starts)), lengths)
    chars = data[flat.positions(starts, lengths)]
    holds = np.stack([flat.segment_sums((~m[chars]).astype(np.int64), lengths) == 0 for m in _MEMBER])
    alphabet = np.argmax(holds, axis=0)
    k = _SIZE[alphabet]
    code = _PLACE[alphabet[owner], chars]
    # uniformity
    width = int(_SIZE.max())
    counts = np.bincount(owner * width + code, minlength=len(starts) * width).reshape(len(starts), width)
    chi = (counts.astype(np.float64) ** 2).sum(1) * k / np.maximum(n, 1) - n
    uniform = _chi_tail(np.maximum(chi, 1e-9), k - 1)
    # runs above and below the middle of the alphabet
    high = code >= (k / 2)[owner]
    inner = owner[1:] == owner[:-1]
    changes = np.bincount(owner[1:][inner & (high[1:] != high[:-1])], minlength=len(starts))
    n1 = flat.segment_sums(high.astype(np.float64), lengths)
    n2 = n - n1
    mean = 2 * n1 * n2 / n + 1
    var = np.maximum((mean - 1) * (mean - 2) / np.maximum(n - 1, 1), 1e-9)
    run = np.where((n1 > 0) & (n2 > 0), _normal_tail((changes + 1 - mean) / np.sqrt(var)), 2.0 ** -(n - 1))
    # correlation of neighbours
    centred = code - (flat.segment_sums(code.astype(np.float64), lengths) / n)[owner]
    square = flat.segment_sums(centred**2, lengths)
    product = np.bincount(owner[1:][inner], (centred[1:] * centred[:-1])[inner], len(starts))
    r = product / np.maximum(square, 1e-9)
    serial = np.where(square > 0, _normal_tail((r + 1 / n) * np.sqrt(n)), 1e-30)
    # Fisher: -2 sum log p is chi-squared with six degrees of freedom
    x = -np.log(np.clip(uniform, 1e-30, 1)) - np.log(np.clip(run, 1e-30, 1)) - np.log(np.clip(serial, 1e-30, 1))
    return np.exp(-x) * (1 + x + x * x / 2), alphabet


def word_models(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of a symbol after another (add one), as counted
    and in the folded case."""
    folded = np.zeros_like(counts)
    np.add.at(folded, (_FOLD[:, None], _FOLD[None, :]), counts)
    kinds = len(np.unique(_FOLD))
    plain = np.log10((counts + 1) / (counts.sum(1, keepdims=True) + len(counts)))
    return plain, np.log10((folded + 1) / (folded.sum(1, keepdims=True) + kinds))


def evidence(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, alphabet: np.ndarray, models: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """-log10 of the bound on the p-value of "these are words"."""
    lengths = ends - starts
    chars = data[flat.positions(starts, lengths)]
    first = np.cumsum(lengths) - lengths
    symbols = _SYMBOL[chars]
    before = np.concatenate([[END], symbols[:-1]])
    before[first] = END
    last = symbols[first + lengths - 1]
    plain, folded = models
    as_is = flat.segment_sums(plain[before, symbols], lengths) + plain[last, END]
    one = flat.segment_sums(folded[_FOLD[before], _FOLD[symbols]], lengths) + folded[_FOLD[last], END]
    # the case of two letters beside each other changes or stays
    letter, capital = _SMALL[chars] | _CAPITAL[chars], _CAPITAL[chars]
    both = np.concatenate([[False], letter[1:] & letter[:-1]])
    both[first] = False
    changed = both & np.concatenate([[False], capital[1:] != capital[:-1]])
    case = np.where(changed, np.log10(CASE_CHANGE), np.log10(1 - CASE_CHANGE)) * both
    words = np.maximum(as_is, one + flat.segment_sums(case, lengths))
    digits = flat.segment_sums((~_MEMBER[0][chars]).astype(np.int64), lengths) == 0
    words = np.where(digits, np.maximum(words, -(1 + NUMBER_DECAY) * lengths), words)
    uniform = -lengths * np.log10(_SIZE[alphabet]) - np.log10(lengths * (lengths + 1.0)) - np.log10(len(ALPHABETS))
    return np.maximum(0.0, uniform - words)


def length_class(lengths: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTH_CLASSES, lengths, side="right") - 1


def cutoffs(histogram: np.ndarray) -> np.ndarray:
    """Benjamini-Hochberg per length class: the least bin of -log10 p that is
    still a discovery (``EVIDENCE_BINS`` if none). A bin counts with its
    largest p-value, so the control holds."""
    out = np.full(len(histogram), EVIDENCE_BINS)
    for k, row in enumerate(histogram):
        found = np.cumsum(row[::-1])[::-1]  # runs in this bin or a stronger one
        p = 10.0 ** (-EVIDENCE_STEP * np.arange(EVIDENCE_BINS))
        good = np.flatnonzero((found > 0) & (p * max(row.sum(), 1) <= FALSE_SHARE * found))
        if len(good):
            out[k] = good[0]
    return out


# --- the jobs ----------------------------------------------------------------------


def neighbour_counts(docs: DataFrame) -> np.ndarray:
    """How often each symbol follows each other one in the runs of all texts
    that are too short to be tested."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((END + 1) ** 2, np.int64)
        for batch in batches:
            for _, _, data, offsets in flat.text_slices(batch.column("text")):
                starts, ends = flat.runs(_TOKEN[data], offsets)
                short = ends - starts < SHORTEST
                starts, ends = starts[short], ends[short]
                if len(starts):
                    symbols = _SYMBOL[data[flat.positions(starts, ends - starts)]]
                    # every run with END after it
                    at = np.cumsum(ends - starts)
                    symbols = np.insert(symbols, at, END)
                    before = np.concatenate([[END], symbols[:-1]])
                    total += np.bincount(before * (END + 1) + symbols, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(seen.astype(np.int32)), "n": pa.array(total[seen])})

    rows = docs.select("text").mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((END + 1) ** 2)
    for r in rows:  # at most one per pair of symbols
        counts[r["pair"]] = r["n"]
    return counts.reshape(END + 1, END + 1)


def _scan_slice(data: np.ndarray, offsets: np.ndarray, models: tuple[np.ndarray, np.ndarray]):
    """Per text its base spans, and its tested runs as rows (text, start,
    end in code points, length class, evidence bin)."""
    n = len(offsets) - 1
    spans: list[list[tuple[int, int, str]]] = [[] for _ in range(n)]
    # only texts that can hold a pattern are searched
    marks = flat.counts_per_document((data == ord("=")) | (data == ord(":")), offsets) > 0
    hex_start, hex_end = flat.runs(_HEX_BYTE[data], offsets)
    hex_start = hex_start[hex_end - hex_start >= HEX_LENGTH]
    marks[np.searchsorted(offsets, hex_start, side="right") - 1] = True
    k = (data[:-3] == 65) & (data[1:-2] == 75) & (data[2:-1] == 73) & (data[3:] == 65) if len(data) > 3 else np.zeros(0, bool)
    marks[np.searchsorted(offsets, np.flatnonzero(k), side="right") - 1] = True
    for i in np.flatnonzero(marks):
        spans[i] = base_spans(data[offsets[i] : offsets[i + 1]].tobytes().decode())
    starts, ends = flat.runs(_TOKEN[data], offsets)
    keep = ends - starts >= SHORTEST
    starts, ends = starts[keep], ends[keep]
    if not len(starts):
        return spans, [np.zeros(0, np.int64)] * 5
    lengths = ends - starts
    p, alphabet = battery(data, starts, ends)
    found = evidence(data, starts, ends, alphabet, models) + np.log10(np.maximum(p, 1e-300))
    bins = np.clip(found / EVIDENCE_STEP, 0, EVIDENCE_BINS - 1).astype(np.int64)
    bins[p < PASS] = 0  # tested, and no discovery
    text = np.searchsorted(offsets, starts, side="right") - 1
    heads = np.concatenate([[0], np.cumsum(~flat.CONTINUATION[data])])
    start = heads[starts] - heads[offsets[text]]
    end = start + lengths  # token characters are single bytes
    apart = np.array([not any(a < e and s < b for a, b, _ in spans[t]) for t, s, e in zip(text.tolist(), start.tolist(), end.tolist(), strict=True)], bool)
    return spans, [v[apart] for v in (text, start, end, length_class(lengths), bins)]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base (list of kind:start:end), tested runs (classes, bins and
    spans), one row per document."""
    models = word_models(neighbour_counts(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in flat.text_slices(batch.column("text")):
                spans, (text, start, stop, classes, bins) = _scan_slice(data, offsets, models)
                at = np.searchsorted(text, np.arange(end - row + 1))
                lists = lambda v: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(v.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), pa.array([written(s) for s in spans], pa.string()),
                     *(lists(v) for v in (start, stop, classes, bins))],
                    ["doc_id", "base", "starts", "ends", "classes", "bins"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, base string, starts array<int>, ends array<int>, classes array<int>, bins array<int>")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans."""
    found = materialize(scan(docs), "secret-spans")
    histogram = np.zeros((len(LENGTH_CLASSES), EVIDENCE_BINS), np.int64)
    pairs = found.select(F.explode(F.arrays_zip("classes", "bins")).alias("r")).groupBy("r.classes", "r.bins").count()
    for r in pairs.collect():  # at most classes x bins rows
        histogram[r["classes"], r["bins"]] = r["count"]
    least = cutoffs(histogram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            columns = [batch.column(c).to_pylist() for c in ("base", "starts", "ends", "classes", "bins")]
            for base, starts, ends, classes, bins in zip(*columns, strict=True):
                own = [s.split(":") for s in base.split(",")] if base else []
                spans = [(int(a), int(b), kind) for kind, a, b in own]
                for kind in KINDS[:3]:
                    out[f"n_{kind}"].append(sum(s[2] == kind for s in spans))
                out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                spans += [(a, b, "random") for a, b, c, e in zip(starts, ends, classes, bins, strict=True) if e >= max(1, least[c])]
                out["spans"].append(written(sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(out[f"n_{k}"], pa.int64()) for k in KINDS[:3]),
                 pa.array(out["base_sha256"], pa.string()), pa.array(out["spans"], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return found.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
