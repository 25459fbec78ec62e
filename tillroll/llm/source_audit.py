"""Source divergence audit: how far the word use of each source is from that
of the other sources of its language.

A text is tokenized by two C-speed calls: ``bytes.translate`` lowers A-Z and
blanks every byte that is no letter and below 128, ``bytes.split`` gives the
terms. A ``Counter`` per document yields its counts; a task adds them up per
(lang, source) and sends (term, documents, occurrences) rows, so a word
that every document holds crosses the network once per task and source.

Each lang keeps the V terms that at least ``MIN_DOCS`` of its documents
hold. With count occurrences of a term in a group and N of all kept terms,
p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in exact integers. The counts
stay sparse: a term that a source lacks has the p of count 0 there.

* ``pair``: the distance of two sources is the sum of abs(p - q) over all
  kept terms. Terms are cut into blocks and sources into tiles of ``TILE``;
  one task fills the small matrix of a block and a pair of tiles and adds up
  its distances, and a sum over blocks follows. A term that neither tile
  holds adds the same number for each pair, so it is only counted.
* ``term``: the ``TOP_TERMS`` terms that a source uses more than its lang,
  taken first in slices of a group, then of the group.

Cases: a null text, lang or source counts as ''; groups without any term
have their pairs too (with V = 0 all values are 0); repeated rows count
each; a document of any length is cut at blanks into pieces of
``PIECE_BYTES``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PRIOR = 5
TILE = 256          # sources in a tile
BLOCK_ROWS = 16384  # rows of a lang's counts in a block of terms, about
SLICES = 64         # of a group, for its first terms
HELD_TERMS = 200_000  # (group, term) entries that a task holds before it sends them
PIECE_BYTES = 1 << 20
ROWS_AT_ONCE = 64   # documents taken out of Arrow together

# A-Z become a-z, a-z and the bytes of all other letters stay, the rest is blank
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

COUNTS_SCHEMA = "lang string, source string, term string, docs bigint, n bigint"
DISTANCE_SCHEMA = "lang string, a string, b string, value bigint"


def pieces(text: bytes) -> Iterator[bytes]:
    """A translated text in pieces that end at a blank."""
    start = 0
    while len(text) - start > PIECE_BYTES:
        end = text.find(b" ", start + PIECE_BYTES)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def document_counts(text: bytes) -> Counter:
    """Occurrences of each term of one text."""
    counts: Counter = Counter()
    for piece in pieces(text.translate(TABLE)):
        counts.update(piece.split())
    return counts


class GroupCounts:
    """Documents and occurrences per (lang, source) and term; the row of a
    group without a term tells that the group occurs."""

    def __init__(self) -> None:
        self.docs: dict[tuple[bytes, bytes], Counter] = {}
        self.more: dict[tuple[bytes, bytes], Counter] = {}  # occurrences beyond one a document

    def add(self, group: tuple[bytes, bytes], text: bytes) -> None:
        counts = document_counts(text)
        docs = self.docs.setdefault(group, Counter())
        docs.update(counts.keys())
        more = self.more.setdefault(group, Counter())
        for term, n in counts.items():
            if n > 1:
                more[term] += n - 1

    def held(self) -> int:
        return sum(map(len, self.docs.values()))

    def batches(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), docs in self.docs.items():
            more = self.more[lang, source]
            terms = [None, *docs]
            n_docs = [0, *docs.values()]
            n = [0, *[d + more[t] for t, d in docs.items()]]
            yield pa.record_batch(
                [_strings([lang] * len(terms)), _strings([source] * len(terms)), _strings(terms),
                 pa.array(n_docs, pa.int64()), pa.array(n, pa.int64())],
                names=["lang", "source", "term", "docs", "n"],
            )


def _strings(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) rows to the counts of their groups."""
    held = GroupCounts()
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            rows = batch.slice(at, ROWS_AT_ONCE)
            for lang, source, text in zip(*[c.cast(pa.binary()).to_pylist() for c in rows.columns], strict=True):
                held.add((lang, source), text)
            if held.held() > HELD_TERMS:
                yield from held.batches()
                held = GroupCounts()
    yield from held.batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, docs, n; and a row of null term per group."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = texts.mapInArrow(count_terms, COUNTS_SCHEMA)
    return counted.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def smoothed(count: Column, total: Column, terms: Column) -> Column:
    """p of a count among ``total`` over ``terms`` kept terms."""
    over = ((count + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"))
    under = (total + F.lit(PRIOR) * terms).cast("decimal(20,0)")
    return F.when(terms > 0, F.lit(1) + F.call_function("div", over, under)).otherwise(F.lit(0)).cast("bigint")


def block_distances(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Distances of the sources of two tiles over one block of terms. Rows
    without a term list the sources, with the p of an absent term."""
    lang, first, second, block = key
    listed = rows["term"].isna().to_numpy()
    place = rows["place"].to_numpy()
    tile = place // TILE
    sources = rows[listed].drop_duplicates("place").sort_values("place")
    term, seen = pd.factorize(rows["term"][~listed])
    at, p = place[~listed], rows["p"].to_numpy()[~listed]
    names, absent, matrix = {}, {}, {}
    for t in {first, second}:
        own = sources[sources["place"] // TILE == t]
        names[t], absent[t] = own["source"].to_numpy(), own["p"].to_numpy()
        matrix[t] = np.repeat(absent[t][:, None], len(seen), axis=1)
        mine = tile[~listed] == t
        matrix[t][np.searchsorted(own["place"].to_numpy(), at[mine]), term[mine]] = p[mine]
    base = np.abs(absent[first][:, None] - absent[second][None, :])
    # every kept term once for all (in block 0), less those of this block
    total = base * ((int(rows["terms"].iloc[0]) if block == 0 else 0) - len(seen))
    for i, row in enumerate(matrix[first]):
        total[i] += np.abs(matrix[second] - row).sum(axis=1)
    a, b = np.nonzero(np.triu(np.ones(total.shape, bool), 1) if first == second else np.ones(total.shape, bool))
    return pd.DataFrame({"lang": lang, "a": names[first][a], "b": names[second][b], "value": total[a, b]})


def pair_distances(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for all ordered pairs of sources of a lang."""
    tiles = F.floor((F.col("sources") - 1) / TILE)
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    columns = ["lang", "source", "place", "terms", "sources"]
    listed = groups.select(*columns, F.lit(None).cast("string").alias("term"),
                           smoothed(F.lit(0), F.col("total"), F.col("terms")).alias("p"),
                           F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    rows = kept.select(*columns, "term", "p", block.alias("block")).unionByName(listed)
    own = F.floor(F.col("place") / TILE)
    # a tile meets every tile of its lang, each pair of tiles in one place
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), tiles)))
    met = met.select("lang", F.least(own, "other").alias("first"), F.greatest(own, "other").alias("second"), "block",
                     "source", "place", "term", "p", "terms")
    sums = (
        met.groupBy("lang", "first", "second", "block").applyInPandas(block_distances, DISTANCE_SCHEMA)
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("pair")
    return sums.select("lang", "value", both).select("lang", "pair.*", "value")


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("bigint").alias("value"),
                       F.row_number().over(order).alias("rank"))


def first_terms(kept: DataFrame) -> DataFrame:
    """The terms with p above the lang's q, the widest gaps first; a group is
    cut down in slices before its rows meet."""
    gap = (F.col("p") - F.col("q")).alias("value")
    over = kept.filter(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), gap)
    over = over.withColumn("slice", F.pmod(F.xxhash64("item"), F.lit(SLICES)))
    order = Window.partitionBy("lang", "source", "slice").orderBy(F.col("value").desc(), F.col("item").asc())
    over = over.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= TOP_TERMS)
    return ranked(over, "term").filter(F.col("rank") <= TOP_TERMS)


def kept_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The counts of kept terms, with p of the group and q of the lang; and
    one row per group: its total, its place among the sources of its lang,
    the kept terms, sources and blocks of the lang."""
    counts = materialize(term_counts(docs), "audit-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.filter("term IS NOT NULL").select(
        "lang", "source", "term", "n",
        F.sum("docs").over(of_term).alias("term_docs"), F.sum("n").over(of_term).alias("lang_n"),
        (F.col("source") == F.min("source").over(of_term)).alias("first"),
    )
    kept = materialize(kept.filter(F.col("term_docs") >= MIN_DOCS).drop("term_docs"), "audit-kept")
    langs = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count_if("first").alias("terms"), F.count(F.lit(1)).alias("rows")
    )
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    in_lang = Window.partitionBy("lang")
    groups = (
        counts.filter("term IS NULL").select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source",
                *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("total", "lang_total", "terms", "rows")])
        .withColumn("place", F.row_number().over(in_lang.orderBy("source")).cast("bigint") - 1)
        .withColumn("sources", F.count(F.lit(1)).over(in_lang))
        .withColumn("blocks", (F.floor(F.col("rows") / BLOCK_ROWS) + 1).cast("bigint"))
    )
    groups = materialize(groups, "audit-groups")
    placed = kept.drop("first").join(groups, ["lang", "source"])
    return placed.withColumns({
        "p": smoothed(F.col("n"), F.col("total"), F.col("terms")),
        "q": smoothed(F.col("lang_n"), F.col("lang_total"), F.col("terms")),
    }), groups


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank."""
    kept, groups = kept_counts(docs)
    return ranked(pair_distances(kept, groups), "pair").unionByName(first_terms(kept))
