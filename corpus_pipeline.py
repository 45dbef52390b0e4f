"""A training-data pipeline over ``documents``, built from the text operators.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, in
the columns it was given; the last returns encoded documents. Stages are
written as Parquet below the shared checkpoint folder and read back, so each
one starts from files and a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwatch.llm import mixing, neardup, quality, secret_scan, unigram
from tickwatch.llm.common import stored
from tickwatch.llm.queries import model_path, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the combined quality rules keep."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id.

    Documents without words are no copies of each other and stay, as do rows
    without an id; rows that repeat an id count as one document.
    """
    dropped = neardup.near_groups(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by a mark."""
    return secret_scan.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at weights 5, 2, 1 and 150% of all words: a row per pass that takes a document."""
    return mixing.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return unigram.encoded_and_decoded(docs, model_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_redaction),
    ("source_mix", source_mix),
    ("sentencepiece", encoding),
]

#: SQL cannot express the near-copy links and the encoding over whole tables; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
