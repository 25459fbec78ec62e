"""The operators on a small table of odd rows, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import (
    chat_format, exact_dedup, lm_scoring, lsh_forest, mixing, piece_codec, quality_gam, queries, robust_rules,
    secret_scan, toxicity,
)
from tillroll.llm.components import components

WORDS = "the quick brown fox jumps over a lazy dog while many small birds sing songs about old rivers and hills".split()


def _text(seed, n=60):
    return " ".join(WORDS[(seed * 7 + k * k + k * seed) % len(WORDS)] + str((seed * k) % 9) for k in range(n))


BASE = _text(3, 200)
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE.replace(" ", "\n  "), "en", "b"), (4, BASE + " tail", "en", "b"),
    (5, "start " + BASE, "de", "c"), (6, None, None, None), (7, "", "en", "a"), (8, " \n", "en", None), (9, "one two", "en", "c"),
    (10, "one two", "en", "c"), (11, _text(5), "en", "a"), (12, _text(8), "en", "b"), (12, _text(8), "en", "b"),
    (13, "é " * 3000, "fr", "c"), (14, "x" * 100_000, "en", "d"), (None, "no id here", "en", "a"), (15, _text(9, 4), "en", "d"),
    (16, "password=abcdefgh12 stupid idiot " + _text(11), "en", "a"), (17, "A" * 30 + " " + "z9" * 20, "en", "a"),
] + [(20 + k, _text(30 + k, 40 + k), "en", "abc"[k % 3]) for k in range(30)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string")
    names = ["score", "size", "kept", "hash", "group", "rep", "block", "bucket_", "id", "body", "taken", "block_"]
    return rows.select("*", F.length("text").cast("bigint").alias("n_chars"), *[F.lit("clash").alias(c) for c in names]).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 3 and 1, int(i == 16)) for i, *_ in ROWS if i] + [(None, 1, 1), (11, None, None), (999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup(docs):
    groups = {}
    for i, text, *_ in ROWS:
        groups.setdefault(_norm(text), []).append(i)
    want = []
    for i, text, *_ in ROWS:
        own = groups[_norm(text)]
        keep = min((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256(_norm(text).encode()).hexdigest()))
    assert _rows(exact_dedup.dedup(docs)) == sorted(want, key=str)
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def _links(rows):
    """(id, class, links) of every row; rows without an id count too."""
    sets, group = [(i, _shingles(t)) for i, t in rows], list(range(len(rows)))
    out = Counter()

    def find(a):
        while group[a] != a:
            a = group[a]
        return a

    for a, (_, s) in enumerate(sets):
        for b, (_, t) in enumerate(sets[:a]):
            if s and t and 5 * len(s & t) >= 4 * len(s | t):
                out[a] += 1
                out[b] += 1
                group[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        least[find(a)] = min((x for x in (i, least.get(find(a))) if x is not None), default=None)
    return sorted(((i, least[find(a)], out[a]) for a, (i, _) in enumerate(sets)), key=str)


def test_jaccard_join_equals_brute_force(docs, spark):
    got = lsh_forest.join_classes(docs).select("doc_id", "class_id", "n_links")
    assert _rows(got) == _links([(r[0], r[1]) for r in ROWS])
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = lsh_forest.join_classes(table).select("doc_id", "class_id", "n_links")
    assert _rows(got) == _links([(r["doc_id"], r["text"]) for r in table.collect()])


def test_links_go_by_text_where_ids_repeat_or_lack(spark):
    a, b, c = _text(3, 60), _text(5, 60), _text(8, 60)
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (None, "start " + b), (None, c), (None, c), (None, c + " tail"),
            (4, c + " tail end"), (5, "q w e r"), (None, "q w e r"), (6, None), (None, None), (None, ""), (7, a), (7, a), (7, "other words")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id bigint, text string, root int")
    got = lsh_forest.join_classes(docs).select("doc_id", "class_id", "n_links")
    assert _rows(got) == _links(rows)
    left = lsh_forest.one_of_each(docs)
    assert left.columns == docs.columns
    # one row of each group; of the texts of 1, each stands for its own
    assert sorted(r["root"] for r in left.collect()) == [0, 1, 8, 9, 11, 12, 13, 16]


def test_components_of_stars_and_chains(spark):
    """A star with a centre of a large, a small and a middle number."""
    star = lambda c, low, high: [(c, v) for v in range(low, high) if v != c]
    edges = star(0, 1, 300) + star(999, 700, 1000) + star(1500, 1400, 1600) + [(k, k + 1) for k in range(2000, 2040)] + [(5, 5)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {v: 0 for v in range(1, 300)} | {v: 700 for v in range(701, 1000)} | {v: 1400 for v in range(1401, 1600)}
    assert got == want | {v: 2000 for v in range(2001, 2041)}


def test_a_group_of_many_tiles_keeps_all_links(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "TILE", 8)
    rows = [(k, " ".join(BASE.split()[: 200 - k % 5] + [f"w{k}"])) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = lsh_forest.join_classes(df).select("doc_id", "class_id", "n_links")
    assert _rows(got) == _links(rows)


def test_mix(docs):
    mixed = mixing.mix(docs, [3.0, 1.0, 2.0])
    rows = mixed.collect()
    assert len(rows) == len(ROWS)
    size = Counter()
    for i, text, _, source in ROWS:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(order)}
    held, budget = set(), 1.5 * sum(size.values())
    while True:
        level = (budget - sum(2 * size[s] for s in held)) / sum(weight[s] for s in order if s not in held)
        over = {s for s in order if s not in held and level * weight[s] > 2 * size[s]}
        if not over:
            break
        held |= over
    taken = Counter()
    for r in rows:
        want = 2 * size[r["source"]] if r["source"] in held else level * weight[r["source"]]
        assert r["source_size"] == size[r["source"]] and math.isclose(r["target"], want)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[r["source"]] - r["target"]) <= 0.5 for r in rows)
    assert _rows(mixed) == _rows(mixing.mix(docs.repartition(5), [3.0, 1.0, 2.0]))
    assert mixing.repeat_documents(docs, mixed).columns == docs.columns


def test_language_model_equals_brute_force(docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "VOCABULARY", 20)
    monkeypatch.setattr(lm_scoring, "CONTEXTS", 6)
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 4000)
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, queries.fold(5) != 1).collect()}
    texts = [(i, [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]) for i, t, *_ in ROWS]
    trained = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 != 1
    c1 = Counter(w for i, t in texts if trained(i) for w in [*t, None])
    n, v = sum(c1.values()), len(c1)
    p1 = lambda w: (c1[w] + 0.5) / (n + 0.5 * (v + 1))
    hashed = {w: _hash(w) for w in c1 if w}
    top = sorted(hashed, key=lambda w: (-c1[w], hashed[w]))[:20]
    rest = 1 - sum(p1(w) for w in [*top, None])
    kind = lambda w: w if w is None or w in top else "?"
    q1 = lambda k: rest if k == "?" else p1(k)
    c2, c3, c = Counter(), Counter(), Counter()
    for i, t in texts:
        s = [None, *map(kind, t), None]
        if trained(i):
            c.update(s[:-1])
            c2.update(zip(s, s[1:]))
            c3.update(zip(s, s[1:], s[2:]))
    p2 = lambda a, b: (c2[a, b] + lm_scoring.K2 * q1(b)) / (c[a] + lm_scoring.K2)
    deep = {None, *top[:6]}
    for i, t in texts:
        words, s = [*t, None], [None, *map(kind, t), None]
        total = 0.0
        for k in range(1, len(s)):
            p = p2(s[k - 1], s[k])
            if k >= 2 and s[k - 2] in deep and s[k - 1] in deep:
                a = s[k - 2], s[k - 1]
                p = (c3[(*a, s[k])] + lm_scoring.K3 * p) / (c2[a] + lm_scoring.K3)
            total += math.log10(p) + (math.log10(p1(words[k - 1]) / rest) if s[k] == "?" else 0)
        r = got[i]
        assert (r["n_tokens"], r["train_tokens"], r["n_known"]) == (len(words), n, sum(c1[w] > 0 for w in words))
        assert math.isclose(r["base_score"], sum(math.log10(p1(w)) for w in words), rel_tol=1e-9)
        assert abs(r["score"] - total) <= len(words) * 1.6 / lm_scoring.STEPS
        assert r["held_out"] == (not trained(i))


def test_language_model_counts_all_words_and_contexts(spark, monkeypatch):
    """A trigram of words far from the most frequent counts, over blocks."""
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 20_000)
    texts = [" ".join(f"w{(k * 97 + j) % 12_000}" for j in range(60)) for k in range(400)] + ["w7 w8 w9 new w10", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, F.col("doc_id") < 400).collect()}
    c = [Counter(), Counter(), Counter()]
    for t in texts[:400]:
        s = [None, *t.split(), None]
        c[0].update(s[1:])
        c[1].update(zip(s, s[1:]))
        c[2].update(zip(s, s[1:], s[2:]))
    n, v = sum(c[0].values()), len(c[0])
    assert v > 10_000
    for i, t in enumerate(texts):
        s, total = [None, *t.split(), None], 0.0
        for k in range(1, len(s)):
            p = (c[0][s[k]] + 0.5) / (n + 0.5 * (v + 1))
            p = (c[1][s[k - 1], s[k]] + lm_scoring.K2 * p) / (c[0][s[k - 1]] + lm_scoring.K2)
            if k >= 2:
                p = (c[2][tuple(s[k - 2 : k + 1])] + lm_scoring.K3 * p) / (c[1][s[k - 2], s[k - 1]] + lm_scoring.K3)
            total += math.log10(p)
        assert (got[i]["n_tokens"], got[i]["train_tokens"]) == (len(s) - 1, n)
        assert abs(got[i]["score"] - total) <= (len(s) - 1) * 0.6 / lm_scoring.STEPS


def _hash(word):
    import numpy as np

    from tillroll.llm import flat

    raw = np.frombuffer(word.encode(), np.uint8)
    return int(flat.piece_hashes(raw, np.array([0]), np.array([len(raw)])).view(np.int64)[0])


def test_pieces(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))
    want = []
    for i, text, *_ in ROWS:
        ids = library.encode(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    raw = queries.piece_model()
    assert _rows(piece_codec.round_trip(docs, raw)) == sorted(want, key=str)
    back = piece_codec.decode(piece_codec.encode(docs, raw), raw)
    assert {r["doc_id"]: r["decoded"] for r in back.collect()} == {i: library.decode(library.encode(t or "")) for i, t, *_ in ROWS}


def test_secrets(docs):
    got = {r["doc_id"]: r for r in secret_scan.find_secrets(docs).collect()}
    for i, text, *_ in ROWS:
        base = secret_scan.written(secret_scan.base_spans(text or ""))
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(got[i]["spans"].split(","))
    assert got[16]["n_assign"] == 1 and got[6]["spans"] == ""


def test_rules_and_classifiers(docs, labels):
    judged = {r["doc_id"]: r for r in robust_rules.judged(docs).collect()}
    assert not judged[6]["kept"] and judged[6]["base_failed"] and judged[13]["base_failed"]
    assert judged[11]["kept"] and judged[1]["n_words"] == 200
    for scored in (quality_gam.scored_documents(docs, labels, queries.fold(5) != 0), toxicity.scored_documents(docs, labels, queries.fold(3) != 1)):
        rows = scored.collect()
        assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_learns_from_whole_long_texts(spark):
    """The toxic words stand in the second of 40 segments only."""
    rnd = random.Random(9)
    plain = lambda n: [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n)]
    bad = "zzkrag vukkol qrazz wobbix".split()
    text = lambda toxic: " ".join(plain(36) + (bad * 4 if toxic else plain(16)) + plain(1228))
    rows = [(k, text(k % 2)) for k in range(540)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.train_model(docs, labels, F.col("doc_id") < 500)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert sum((got[k] >= 0.5) == (k % 2 == 1) for k in range(500, 540)) >= 37


def test_outliers_are_rejected_per_group(spark):
    rnd = random.Random(6)
    plain = lambda n: " ".join(rnd.choice(WORDS) + str(rnd.randrange(99)) for _ in range(n))
    rows = [(k, plain(60 + k % 40), "en", "a") for k in range(200)] + [(900, " ".join(f"{w}#$%&" for w in plain(80).split()), "en", "a")]
    out = {r["doc_id"]: r for r in robust_rules.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert not out[900]["kept"] and not out[900]["base_failed"]
    assert sum(out[k]["kept"] for k in range(200)) >= 198


def test_chat_round_trip(spark):
    rows = [(c, t, role, f"line {t} of {c}\nmore text?\nand {c * t}") for c in range(40) for t, role in enumerate(["system", "user", "assistant", "user", "assistant"])]
    odd = [(100, 0, None, None), (100, 1, "user", ""), (None, 0, "user", "hi"), (101, None, "user", "x"), (102, 0, "user", "same"), (102, 0, "user", "same")]
    df = spark.createDataFrame(rows + odd, "conv_id bigint, turn bigint, role string, text string")
    turns = chat_format.format_conversations(df).collect()
    right = {(c, t): (role, text) for c, t, role, text in rows}
    hit = sum(right.get((r["conv_id"], r["turn"])) == (r["role"], r["text"]) for r in turns)
    assert hit >= 0.95 * len(rows)
    assert {r["conv_id"] for r in turns} == {r[0] for r in rows + odd}
    assert all(r["rendered"] == f"<|{r['role']}|>\n{r['text']}\n<|end|>" for r in turns)


def test_long_transcripts_are_cut_without_effect(spark, monkeypatch):
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t}\nmore {t}") for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    whole = _rows(chat_format.format_conversations(df))
    monkeypatch.setattr(chat_format, "BLOCK", 7)
    assert _rows(chat_format.format_conversations(df)) == whole


def test_empty_tables(docs, labels, spark):
    none, unlabelled = docs.limit(0), labels.limit(0)
    assert exact_dedup.dedup(none).count() == 0
    assert lsh_forest.join_classes(none).count() == 0
    assert mixing.mix(none, [1.0]).count() == 0
    assert lm_scoring.score(none, queries.fold(5) != 1).count() == 0
    assert robust_rules.judged(none).count() == 0
    assert secret_scan.find_secrets(none).count() == 0
    assert piece_codec.round_trip(none, queries.piece_model()).count() == 0
    assert quality_gam.scored_documents(none, unlabelled, queries.fold(5) != 0).count() == 0
    assert toxicity.scored_documents(none, unlabelled, queries.fold(3) != 1).count() == 0
    chats = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat_format.format_conversations(chats).count() == 0


def test_pipeline_stages(docs, labels, spark, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == now.columns
        now = out
    assert now.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and now.count() > 0


def test_toxicity_stage_judges_rows_not_ids(spark, monkeypatch):
    """A toxic row without an id goes; the clean rows of its id stay."""
    rows = [(None, "bad bad", 1), (None, "fine", 2), (7, "bad", 3), (7, "fine", 4), (7, "fine", 4), (8, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxicity int")
    monkeypatch.setattr(toxicity, "train_model", lambda *a: toxicity.Model(np.zeros(toxicity.BUCKETS, np.float32), 0.0, 1.0, 0.0, 0.0))
    monkeypatch.setattr(toxicity.Model, "score", lambda self, texts: np.array([0.9 if "bad" in t else 0.1 for t in texts.to_pylist()]))
    clean = toxicity.clean_documents(docs, None, None)
    assert clean.columns == docs.columns and _rows(clean) == sorted([r for r in rows if "bad" not in (r[1] or "")], key=str)


def test_held_out_is_never_null(spark):
    got = spark.createDataFrame([(None,), (3,)], "doc_id bigint").select(queries.held_out(5, 0), queries.fold(5).alias("r")).collect()
    assert [(r[0], r[1]) for r in got] == [(False, None), (zlib.crc32(b"3") % 5 == 0, zlib.crc32(b"3") % 5)]


@pytest.mark.parametrize("name", ["op6_exact_dedup", "op9_source_mixing"])
def test_query_matches_its_sql(spark, tmp_path, name):
    import duckdb

    made = f"{tmp_path}/made"
    rows = [(i, " ".join(["word"] * (i % 23)), ("b", "a", None, "é", "Z")[i % 5 if i % 3 else 0]) for i in range(400)]
    rows += [(7, "again and again", "a"), (7, "again  and\tagain", "a"), (401, None, "a"), (402, "", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(f"{made}/documents.parquet")
    for sf_dir, files in (("/root/testdata/sf0.001", "documents.parquet"), (made, "documents.parquet/*.parquet")):
        duck = duckdb.connect()
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/{files}'")
        got = queries.queries()[name](spark, sf_dir)
        want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
        assert _rows(got) == sorted(want, key=str)
