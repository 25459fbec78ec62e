"""Exact deduplication by 128-bit content hash.

Texts are equal when they are identical after every ``[\\x20\\x09-\\x0D]+``
is replaced by one space. The grouping key is the MD5 of that text with
the text itself beside it: rows meet by hash, and the bytes decide, so two
texts that share a hash make two groups. The aggregate keeps one row per
key and task before the shuffle, so a group of copies of any size reaches
the reducer as a handful of rows.

Cases: a null text counts as empty; repeated rows of one id count each and
share the result of that id; a null id loses against any other id and is
kept only in a group of null ids; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def content_groups(docs: DataFrame) -> DataFrame:
    """One row per distinct normalised text: its hash, the id that stays,
    the number of rows, its SHA-256, and how many texts share the hash."""
    groups = (
        docs.select("doc_id", normalised(F.col("text")).alias("body"))
        .groupBy(F.md5("body").alias("hash"), "body")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return groups.select("hash", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Members find their group by both digests of the text (the MD5 of the
    group and its SHA-256), so the texts cross the network once.
    """
    body = normalised(F.col("text"))
    members = docs.select(F.col("doc_id"), F.md5(body).alias("hash"), F.sha2(body, 256).alias("text_sha256"))
    joined = members.join(content_groups(docs), ["hash", "text_sha256"], "left")
    return joined.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("keep_id").cast("bigint").alias("keep_id"),
        F.col("group_size").cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one per text. Of repeated rows of the
    staying id, one stays (the first by the remaining columns)."""
    body = normalised(F.col("text"))
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *rest, F.col("text").alias("text"))
    one = docs.groupBy(F.md5(body).alias("hash_"), body.alias("body_")).agg(F.min(row).alias("row_"))
    return one.select(*[F.col("row_")[c].alias(c) for c in docs.columns])
