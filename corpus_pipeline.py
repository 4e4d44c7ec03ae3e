"""The corpus pipeline: documents to packed training sequences.

Toxic documents go, one document of each group of near copies stays, documents that hold benchmark passages
go, personal data is covered, and what is left is packed. Each stage's output is written to the shared folder
and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm import decontamination, jaccard, packing, pii, toxicity
from qaloom.llm.common import free_name, small_batches, table
from qaloom.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5, unchanged. Labels of fold 0 are not learnt from."""
    small_batches(spark)
    classifier = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return toxicity.score_texts(docs, classifier, name=score).where(F.col(score) < 0.5).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle Jaccard similarity 0.8 or more, that with the smallest id."""
    small_batches(spark)
    return jaccard.one_of_each(docs, size=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    small_batches(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def cover_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; ``n_chars`` follows the text."""
    small_batches(spark)
    covered = pii.redact(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        covered = covered.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return covered.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and place there."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("personal data", cover_personal),
    ("packing", pack),
]

# Trained models decide in two stages: SQL cannot express them. tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through every stage; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
