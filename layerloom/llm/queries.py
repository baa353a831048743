"""The registered queries of the operators: ``name -> f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.llm.bloom_cascade import judge_urls
from layerloom.llm.common import table
from layerloom.llm.conversations import repair_damaged
from layerloom.llm.cross_polytope import neighbours
from layerloom.llm.mixing import mix
from layerloom.llm.partenum import join_documents
from layerloom.llm.pieces import encode_documents
from layerloom.llm.pitman_yor import score_documents
from layerloom.llm.quality import rate_documents
from layerloom.llm.secrets import scan_secrets, secret_digest
from layerloom.llm.spelling import spelling_variants
from layerloom.llm.surrogates import replace_documents
from layerloom.llm.token_files import token_index
from layerloom.llm.topk import top_k


def op1_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(table(spark, sf_dir, "documents")))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_encode_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


def op4_rate_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_join_shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_replace_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_documents(table(spark, sf_dir, "documents"))


def op9_score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op10_judge_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_scan_secrets": op1_scan_secrets,
    "op2_top_k": op2_top_k,
    "op3_encode_pieces": op3_encode_pieces,
    "op4_rate_quality": op4_rate_quality,
    "op5_mix_sources": op5_mix_sources,
    "op6_join_shingles": op6_join_shingles,
    "op7_neighbours": op7_neighbours,
    "op8_replace_entities": op8_replace_entities,
    "op9_score_documents": op9_score_documents,
    "op10_judge_urls": op10_judge_urls,
    "op11_repair_conversations": op11_repair_conversations,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling_variants,
}
