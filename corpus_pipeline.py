"""Documents to training ids in five stages.

Each stage takes all rows that the one before kept, written as Parquet and read again; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from layerloom.llm.common import table, written
from layerloom.llm.mixing import mix_documents
from layerloom.llm.partenum import drop_copies
from layerloom.llm.pieces import encode_documents
from layerloom.llm.quality import select_quality
from layerloom.llm.secrets import redact_secrets

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rates as good; the others go."""
    return select_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, as often as it takes them."""
    return mix_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding gives it back."""
    return encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scans", secrets),
    ("mixing_sources", mixing),
    ("sentencepiece_encoding", pieces),
]

#: SQL cannot express the fitted and inferred stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
