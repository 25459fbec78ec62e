"""Source audit, VA-file clustering and token files against brute force and
the tokenizers library, on odd rows."""

from __future__ import annotations

import glob
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillroll.llm import queries, source_audit, token_files, va_clustering

WORDS = "the Quick brown FOX jumps over a lazy dog while many ÉTÉ straße naïve ÀÉ songs about old rivers 漢字 and hills".split()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _with_clashes(df):
    names = ["term", "n", "docs", "total", "place", "p", "q", "first", "part", "row", "hash", "key", "cells", "integers", "start", "ids"]
    return df.select("*", *[F.lit("clash").alias(c) for c in names if c not in df.columns])


# --- source audit ---------------------------------------------------------------

def _audit_rows():
    rnd = random.Random(11)
    rows = []
    for k in range(260):
        source = rnd.choice(["a", "b", "c", "Z", "é"]) if k % 3 else "a"  # a third of all rows in one source
        words = [rnd.choice(WORDS if source != "c" else WORDS[:9]) for _ in range(k % 30)]
        rows.append((k, rnd.choice([" ", "-", "\n", "9"]).join(words), ("en", "de")[k % 7 == 0], source))
    rows += [(5, rows[5][1], "en", "a")] * 3  # repeated rows
    rows += [(300, None, "en", "a"), (301, "", "en", None), (302, "fox fox", None, "a"), (303, "the", None, None)]
    rows += [(304, "only here " * 3, "xx", s) for s in ("u", "v")]  # a lang without kept terms
    rows += [(305, "the " * 90_000 + "y" * 70_000, "en", "b"), (None, "lazy dog", "en", "c")]
    return rows


def _audit_by_force(rows, min_docs=30):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, counts, groups = {}, {}, set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower)))
        groups.add((lang, source))
        docs.setdefault(lang, Counter()).update(terms.keys())
        counts.setdefault((lang, source), Counter()).update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = sorted(s for g, s in groups if g == lang)

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = p(sum((counts[lang, s] for s in own), Counter()))
        each = {s: p(counts[lang, s]) for s in own}
        for s in own:
            parts = {"pair": [(sum(abs(each[s][t] - each[o][t]) for t in kept), o) for o in own if o != s],
                     "term": [(each[s][t] - q[t], t) for t in kept if counts[lang, s][t] and each[s][t] > q[t]]}
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found) if part == "pair" or k < 50]
    return out


def test_audit_equals_brute_force(spark, monkeypatch):
    rows = _audit_rows()
    docs = _with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).repartition(4)
    want = sorted(_audit_by_force(rows), key=str)
    assert {r[2] for r in want} == {"pair", "term"} and any(r[0] == "xx" for r in want)
    assert _rows(source_audit.audit(docs)) == want
    # tiles of two sources, small blocks, slices, pieces and flushes: the same rows
    for name, value in (("TILE", 2), ("BLOCK_ROWS", 7), ("SLICES", 3), ("PIECE_BYTES", 50), ("HELD_TERMS", 5), ("ROWS_AT_ONCE", 3)):
        monkeypatch.setattr(source_audit, name, value)
    assert _rows(source_audit.audit(docs)) == want


def test_audit_is_exact_beyond_64_bits(spark):
    """10^9 times a count of 10^13 does not fit 64 bits."""
    count, total, terms = 9_876_543_210_987, 98_765_432_109_876_543, 1_234_567
    got = spark.range(1).select(source_audit.smoothed(*[F.lit(x).cast("bigint") for x in (count, total, terms)])).first()[0]
    assert got == 1 + 10**9 * (count + 5) // (total + 5 * terms)


def test_audit_of_no_rows(spark):
    assert source_audit.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


# --- clustering -------------------------------------------------------------------

def _cluster_by_force(rows, k=40, rounds=5):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, tuple(int(np.floor(256.0 * x)) for x in v)))
    def key(row):
        return ("none" if row[0] is None else hashlib.sha256(f"2:{row[0]}".encode()).hexdigest(), row[1])
    centroids = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        members = {}
        for (_, v), (_, n) in zip(kept, assign()):
            members.setdefault(n, []).append(v)
        for n, own in members.items():
            centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    final = assign()
    inertia = Counter()
    for d, n in final:
        inertia[n] += d
    return sorted(
        ((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
         for (i, _), (d, n) in zip(kept, final)), key=str)


def _vectors(n=160):
    rnd = random.Random(3)
    f = lambda x: float(np.float32(x))
    rows = [(i, [f(rnd.gauss(0.3 * (i % 5), 0.12)) for _ in range(64)]) for i in range(n)]
    same = rows[4][1]
    rows += [(500 + i, same) for i in range(80)]  # a third are copies of one vector
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[10][1])]
    rows += [(600, None), (601, []), (602, same[:63]), (603, same + [0.0]), (604, [None] + same[1:]),
             (605, [float("nan")] + same[1:]), (606, [float("inf")] + same[1:]), (607, [float("-inf")] + same[1:])]
    return rows


@pytest.mark.parametrize("kind", ["float", "double"])
def test_clusters_equal_brute_force(spark, kind):
    rows = _vectors()
    table = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(3)
    got = va_clustering.cluster(_with_clashes(table))
    assert _rows(got.drop("candidates")) == _cluster_by_force(rows)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [0.5 if i % 2 else -0.5] * 64) for i in range(90)]  # two places, forty centroids
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = _rows(va_clustering.cluster(table).drop("candidates"))
    assert got == _cluster_by_force(rows) and len({r[1] for r in got}) == 2


def test_few_and_no_vectors(spark):
    rows = _vectors()[:3]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert _rows(va_clustering.cluster(table).drop("candidates")) == _cluster_by_force(rows)
    assert va_clustering.cluster(table.limit(0)).count() == 0


def test_cells_spare_measuring(spark):
    """Of well separated groups most vectors are decided by their cells; the
    intervals hold the true distances."""
    rnd = np.random.default_rng(5)
    centres = rnd.integers(-200, 200, (8, 64))
    vectors = centres[rnd.integers(0, 8, 4000)] + rnd.integers(-9, 10, (4000, 64))
    stats = [{"dimension": d, "n": 4000, "total": float(vectors[:, d].sum()), "squares": float((vectors[:, d] ** 2).sum()),
              "least": int(vectors[:, d].min()), "largest": int(vectors[:, d].max())} for d in range(64)]
    cells = va_clustering.Cells(stats)
    packed, bounds = cells.encode(vectors), cells.bounds(centres)
    found, candidates = va_clustering.nearest(vectors, packed, centres, bounds)
    true = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (found == true.argmin(axis=1)).all() and (candidates == 1).mean() > 0.95
    ends = sum(bounds[p][packed[:, p]] for p in range(32))
    assert (ends[:, :8] <= true).all() and (true <= ends[:, 8:]).all()


def test_components_beyond_the_exact_range_raise(spark):
    table = spark.createDataFrame([(1, [1e9] * 64)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        va_clustering.cluster(table).collect()


# --- token files --------------------------------------------------------------------

ODD_TEXTS = [
    None, "", " \n\t", "plain words, it's we'll I'd", "a\x0bb\x0cc\rd\te", "x\x1cy\x1fz\x85w v u　t", "nul \x00 byte\x00",
    "<|endoftext|> in <|startoftext|>x<|endoftext|>", "ΣΊΣΥΦΟΣ ΑΣ", "é ́ e ́x", "İstanbul ŐŰ ǅ", "漢字かな交じり文 한국어 각",
    "👩‍👩‍👧 emoji 🇩🇪", "12345 x9y", "don't 'S 'LL ''s", "A" * 5000, "word " * 4000, "tab\tand\nline\r\nend ", "naïve ﬁ ½ ²", "the end",
]


def _token_rows():
    rnd = random.Random(2)
    rows = [(10 * k, t) for k, t in enumerate(ODD_TEXTS)]
    rows += [(k, " ".join(rnd.choice(WORDS) + rnd.choice(["", "s", "!", "7"]) for _ in range(rnd.randrange(60)))) for k in range(1001, 1150)]
    rows += [(-5, "negative"), (3, "same id"), (3, "same id"), (3, "other text"), (None, "no id"), (None, None)]
    return rows


def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(queries.TOKEN_MODEL))


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    docs = _with_clashes(spark.createDataFrame(_token_rows(), "doc_id bigint, text string")).repartition(3)
    spec = token_files.load_tokenizer(public_tokenizers.path(queries.TOKEN_MODEL))
    return token_files.write_token_files(docs, f"file://{tmp_path_factory.mktemp('tokens')}/files", spec)


def _ids(text):
    return _library().encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_equal_the_library(files):
    got = files.documents().collect()
    library = {t: _ids(t) for _, t in _token_rows()}
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(i), library[t]) for i, t in _token_rows())
    stream = sorted(got, key=lambda r: r["start"])
    ids = [r["doc_id"] for r in stream]
    assert ids == sorted((i for i in ids if i is not None)) + [None, None]
    start = 0
    for r in stream:
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]))
        start += r["n_tokens"]
    crc = {(r["doc_id"], r["start"], r["n_tokens"]): r["ids_crc32"] for r in token_files.digests(files).collect()}
    assert crc == {(r["doc_id"], r["start"], r["n_tokens"]): zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got}


def _by_slices(encoder, rows, per_slice):
    for at in range(0, len(rows), per_slice):
        texts = [(t or "").encode() for _, t in rows[at : at + per_slice]]
        offsets = np.cumsum([0, *map(len, texts)])
        ids, n = token_files.encode_slice(encoder, np.frombuffer(b"".join(texts), np.uint8), offsets, 1)
        yield from np.split(ids, np.cumsum(n)[:-1])


@pytest.mark.parametrize("per_slice", [1, 7, 1000])
def test_small_caches_change_nothing(monkeypatch, per_slice):
    spec = token_files.load_tokenizer(public_tokenizers.path(queries.TOKEN_MODEL))
    rows = _token_rows()
    want = [_ids(t) for _, t in rows]
    assert [x.tolist() for x in _by_slices(token_files.PieceIds(spec), rows, per_slice)] == want
    monkeypatch.setattr(token_files, "CACHE_WORDS", 5)
    monkeypatch.setattr(token_files, "NEW_AT_ONCE", 3)
    monkeypatch.setattr(token_files, "TABLE_BITS", 2)  # nearly every piece meets another
    assert [x.tolist() for x in _by_slices(token_files.PieceIds(spec), rows, per_slice)] == want


def test_random_texts_equal_the_library():
    """All kinds of characters beside each other, special tokens too."""
    rnd = random.Random(8)
    kinds = ["aZ", "09", "'", "<|endoftext|>", "<|", ",.;!?-_", "éßÀİΣς", "́̈", " \t\n\x0b", "\x1c\x85\u00a0\u2003",
             "漢字한", "½²Ⅷ", "…“”", "\x00\x7f", "'s", "'LL", "ǅ", "🇩🇪"]
    rows = []
    for k in range(1500):
        parts = (rnd.choice(kinds) for _ in range(rnd.randrange(25)))
        rows.append((k, "".join(p if len(p) > 2 or rnd.random() < 0.3 else rnd.choice(p) for p in parts)))
    encoder = token_files.PieceIds(token_files.load_tokenizer(public_tokenizers.path(queries.TOKEN_MODEL)))
    library = _library()
    for (_, text), ids in zip(rows, _by_slices(encoder, rows, 40)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids + [1], repr(text)


def test_spans_and_ranges_of_the_stream(files):
    rows = sorted(files.documents().collect(), key=lambda r: r["start"])
    stream = [i for r in rows for i in r["ids"]]
    for start, end in ((0, 10), (7, 400), (len(stream) - 3, len(stream)), (100, 100)):
        span = sorted(files.span(start, end).collect(), key=lambda r: r["start"])
        assert [i for r in span for i in r["ids"]] == stream[start:end]
    assert _rows(files.documents(1005, 1010).select("doc_id", "ids")) == sorted(
        ((r["doc_id"], r["ids"]) for r in rows if r["doc_id"] and 1005 <= r["doc_id"] <= 1010), key=str)
    plan = files.metadata()._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan


def test_layout_of_the_files(files):
    spec = {}
    for path in glob.glob(files.path.removeprefix("file://") + "/data/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for c in range(meta.num_columns if meta.num_row_groups else 0):
            column = meta.row_group(0).column(c)
            assert column.has_column_index and column.has_offset_index
            spec[column.path_in_schema] = column.encodings
    for name in token_files.COUNTERS:
        assert "DELTA_BINARY_PACKED" in spec[name]
    assert "RLE_DICTIONARY" in spec["ids.list.element"]


def test_row_groups_and_pages_are_controlled_and_skipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "ROW_GROUP_BYTES", 64 << 10)
    monkeypatch.setattr(token_files, "PAGE_ROWS", 100)
    rnd = random.Random(4)
    docs = spark.createDataFrame([(k, " ".join(rnd.choices(WORDS, k=60))) for k in range(6000)], "doc_id bigint, text string").coalesce(1)
    spec = token_files.load_tokenizer(public_tokenizers.path(queries.TOKEN_MODEL))
    monkeypatch.setattr(token_files, "encoded", lambda d, s, e, real=token_files.encoded: real(d, s, e).coalesce(1))
    files = token_files.write_token_files(docs, f"file://{tmp_path}/t", spec)
    paths = [p for p in glob.glob(f"{tmp_path}/t/data/*.parquet")]
    assert sum(pq.ParquetFile(p).metadata.num_row_groups for p in paths) > 4
    few = files.documents(3000, 3010)
    assert sorted(r["doc_id"] for r in few.collect()) == list(range(3000, 3011))
    scans, todo = [], [few._jdf.queryExecution().executedPlan()]
    while todo:  # rows that left the scan of the data files
        node = todo.pop()
        if "FileSourceScan" in node.getClass().getSimpleName() and "ids" in node.toString():
            scans.append(node.metrics().apply("numOutputRows").value())
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    assert scans and 11 <= sum(scans) <= 400


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        token_files.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_files_of_no_rows(spark, tmp_path):
    spec = token_files.load_tokenizer(public_tokenizers.path(queries.TOKEN_MODEL))
    files = token_files.write_token_files(spark.createDataFrame([], "doc_id bigint, text string"), f"file://{tmp_path}/none", spec)
    assert token_files.digests(files).count() == 0 and files.metadata().count() == 0 and files.span(0, 5).count() == 0


# --- registered queries ---------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_source_audit", "op12_centroid_clustering"])
def test_query_matches_its_sql(spark, tmp_path, name):
    import duckdb

    made = f"{tmp_path}/made"
    spark.createDataFrame(_audit_rows(), "doc_id bigint, text string, lang string, source string").write.parquet(f"{made}/documents.parquet")
    unique = {r[0]: r for r in _vectors()}.values()  # of repeated null ids, SQL and library may order differently
    spark.createDataFrame(list(unique), "vec_id bigint, embedding array<float>").write.parquet(f"{made}/embeddings.parquet")
    for sf_dir, files in (("/root/testdata/sf0.001", ""), (made, "/*.parquet")):
        duck = duckdb.connect()
        for table in ("documents", "embeddings"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet{files}'")
        got = queries.queries()[name](spark, sf_dir)
        want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
        assert _rows(got) == sorted(want, key=str)
