"""The registered queries of the operators, and their SQL where SQL can
express them: ``queries()`` and ``oracle_sql()`` as in the catalog."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    chat_format, exact_dedup, lm_scoring, lsh_forest, mixing, piece_codec, quality_gam, robust_rules, secret_scan,
    source_audit, token_files, toxicity, va_clustering,
)
from tillroll.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = "piece_bpe_32k.model"
TOKEN_MODEL = "word_bpe_49k.json"
MIX_WEIGHTS = [3.0, 1.0, 2.0]
MIX_BUDGET = 1.5
MIX_EPOCHS = 2.0


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo a number."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def held_out(modulus: int, remainder: int) -> Column:
    """Has doc_id this remainder? A null id has none: false."""
    return F.coalesce(fold(modulus) == remainder, F.lit(False)).alias("held_out")


def piece_model() -> bytes:
    return piece_codec.load_model(public_tokenizers.path(PIECE_MODEL))


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_conversations(read(spark, sf_dir, "conversations"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = quality_gam.scored_documents(docs, labels, fold(5) != 0)
    return scored.select("doc_id", held_out(5, 0), "score", "predicted")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = robust_rules.judged(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", *robust_rules.COUNTS, "base_failed", "kept")


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(read(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trip(read(spark, sf_dir, "documents"), piece_model())


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = toxicity.scored_documents(docs, labels, fold(3) != 1)
    return scored.select("doc_id", held_out(3, 1), "score", "predicted")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read(spark, sf_dir, "documents"), ~held_out(5, 1))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_BUDGET, MIX_EPOCHS)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.join_classes(read(spark, sf_dir, "documents"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = va_clustering.cluster(read(spark, sf_dir, "embeddings"))
    return clustered.drop("candidates")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = token_files.load_tokenizer(public_tokenizers.path(TOKEN_MODEL))
    docs = read(spark, sf_dir, "documents")
    return token_files.digests(token_files.write_token_files(docs, scratch_path(spark, "token-files"), spec))


OP6_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), groups AS (
  SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM texts JOIN groups USING (body)
"""

# the water level with the first k sources clamped (least size per weight
# first), where k is the first at which no other is above its cap; later
# ones give lower levels
OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place
  FROM documents
), sources AS (
  SELECT source, source_size, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] :: DOUBLE AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
), levels AS (
  SELECT 2.0 :: DOUBLE * source_size / weight AS full_at,
         (1.5 :: DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0 :: DOUBLE * source_size) OVER upto, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER upto, 0)) AS level
  FROM sources
  WINDOW upto AS (ORDER BY 2.0 :: DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), plan AS (
  SELECT *, least(weight * (SELECT max(level) FROM levels WHERE full_at >= level), 2.0 :: DOUBLE * source_size) AS target
  FROM sources
), goals AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole
  FROM plan
)
SELECT doc_id, s.source, size, source_size, target,
       CAST(whole * size + least(size, greatest(0, goal - whole * source_size - coalesce(sum(size) OVER (
         PARTITION BY s.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
"""

# p and q as HUGEINT, since 10^9 times a count can pass 64 bits; a group
# gives every kept term of its lang, so the counts are dense here
OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
), words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), vocabulary AS (
  SELECT lang, term, count(*) :: HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30
), langs AS (
  SELECT lang, sum(n) :: HUGEINT AS total, count(*) :: HUGEINT AS terms FROM vocabulary GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) :: HUGEINT AS n FROM words SEMI JOIN vocabulary USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) :: HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), dense AS (
  SELECT t.lang, t.source, v.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (t.total + 5 * l.terms) AS p,
         1 + (1000000000 * (v.n + 5)) // (l.total + 5 * l.terms) AS q
  FROM totals t JOIN vocabulary v USING (lang) JOIN langs l USING (lang)
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = v.term
), distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM dense WHERE n > 0 AND p > q
), ranks AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM rows
)
SELECT * FROM ranks WHERE part = 'pair' OR rank <= 50
"""


def _op12_sql() -> str:
    """The rounds one after another: distances of all vectors to all
    centroids, the nearest, and the floored means."""
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = ["""
vectors AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, x) - 1 AS c, x FROM vectors
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, x) <= 40
)"""]
    for i in range(6):
        steps.append(f"""
a{i} AS (
  SELECT r, d, c FROM (SELECT v.r, c.c, {square} AS d FROM vectors v CROSS JOIN c{i} c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if i < 5:
            steps.append(f"""
m{i} AS (
  SELECT c, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
  FROM (SELECT a.c, e.i, sum(v.x[e.i]) AS total, count(*) AS n
        FROM a{i} a JOIN vectors v USING (r) CROSS JOIN (SELECT unnest(range(1, 65)) AS i) e GROUP BY a.c, e.i)
  GROUP BY c
), c{i + 1} AS (SELECT c{i}.c, coalesce(m.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} m USING (c))""")
    return f"""
WITH {",".join(steps)}
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c5.x, ',')) AS centroid_sha256
FROM a5 a JOIN vectors v USING (r) JOIN c5 ON c5.c = a.c
"""


OP12_SQL = _op12_sql()


def queries() -> dict[str, QueryFn]:
    named = [
        op1_chat_formatting, op2_quality_classifier, op3_quality_rules, op4_secret_scans, op5_sentencepiece, op6_exact_dedup,
        op7_toxicity, op8_lm_scoring, op9_source_mixing, op10_ngram_jaccard_join,
        op11_source_audit, op12_centroid_clustering, op13_token_files,
    ]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": OP6_SQL, "op9_source_mixing": OP9_SQL, "op11_source_audit": OP11_SQL, "op12_centroid_clustering": OP12_SQL}
