"""The registered queries of the numbered operators; each reads its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lineagespark.llm import (
    op01_packing, op02_quality, op03_chat, op04_jaccard, op05_language, op06_suffixes, op07_mixing, op08_urls, op09_lines, op10_fingerprints,
    op11_secrets, op12_phrases, op13_alignment,
)
from lineagespark.llm.common import table
from lineagespark.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_packing.pack(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_quality.quality_report(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_chat.chat_documents(table(spark, sf_dir, "conversations"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op05_language.identify_languages(table(spark, sf_dir, "documents"))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_suffixes.repeat_report(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_mixing.mix(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_urls.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_lines.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines_removed", "text")


def op10_fingerprints_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op11_secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_secrets.secret_report(table(spark, sf_dir, "documents"))


def op12_phrases_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_phrases.collocations(table(spark, sf_dir, "documents"))


def op13_alignment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_alignment.cross_alignment(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing, "op2_quality": op2_quality, "op3_chat": op3_chat, "op4_jaccard": op4_jaccard, "op5_language": op5_language,
    "op6_suffixes": op6_suffixes, "op7_mixing": op7_mixing, "op8_urls": op8_urls, "op9_lines": op9_lines, "op10_fingerprints": op10_fingerprints_query,
    "op11_secrets": op11_secrets_query, "op12_phrases": op12_phrases_query, "op13_alignment": op13_alignment_query,
}
