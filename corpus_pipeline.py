"""Corpus pipeline: documents through five stages, each a whole operator.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before kept; ``run`` writes each result as Parquet in the shared checkpoint
folder and reads it back for the next. All but the last return the columns
of ``documents``. Labels and weights come from ``sf_dir`` and constants of
the registered queries.

Cases (null or empty texts, repeated rows, further columns, empty tables)
are those of the operators. The toxicity stage judges every row by its own
text, with or without an id; the near-copy stage goes by id and text, so a
row without an id goes only if a linked row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import exact_dedup, lsh_forest, mixing, piece_codec, queries, toxicity
from tillroll.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    labels = queries.read(spark, sf_dir, "labels")
    return toxicity.clean_documents(docs, labels, queries.fold(3) != 1)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts."""
    return lsh_forest.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    mixed = mixing.mix(docs, queries.MIX_WEIGHTS, queries.MIX_BUDGET, queries.MIX_EPOCHS)
    return mixing.repeat_documents(docs, mixed)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return piece_codec.round_trip(docs, queries.piece_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode_pieces),
]

# a trained classifier, MinHash and a tokenizer: SQL cannot express them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
