"""From raw documents to training ids: quality rules, near-duplicates, secrets, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import mixing, neardup, quality, secrets, sentencepieces
from riskloom.llm.common import read_table, stored
from riskloom.llm.queries import MIX_SEED, MIX_WEIGHTS, piece_model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep. The text goes through the stored table once instead of being parsed twice."""
    judged = quality.judge(stored(quality.measure(docs), "quality-measured"))
    return judged.filter("kept").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in them masked."""
    return secrets.redact(docs).select(docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target rate draws it, in shuffled order."""
    return mixing.mix(docs, MIX_WEIGHTS, seed=MIX_SEED).select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and whether they decode to its text."""
    return sentencepieces.training_ids(docs, piece_model()).select(
        "doc_id", "lang", "source", "n_tokens", "ids", "round_trip"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
    ("SentencePiece encoding and decoding", encoding),
]

# The stages hold sketches, compression and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{i}")
    return docs
