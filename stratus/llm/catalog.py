"""Registered queries of the training-data operators and, where SQL can
express them on whole tables, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratus.llm import (decontaminate, embedding_caps, filter_audit, language_id, line_dedup, mixing, pii, prefix_trie,
                         secret_scan, sharding, span_dedup, url_templates)
from stratus.llm.common import table
from stratus.llm.ngram_jaccard import jaccard_groups


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.remove_repeated_spans(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge_urls(table(spark, sf_dir, "pages"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_secret_scan, op3_line_dedup, op4_sharding, op5_mixing,
    op6_benchmark_decontamination, op7_language_id, op8_substring_dedup, op9_url_filters,
    op10_embedding_near_dedup, op11_conversation_prefix_trie, op12_filter_interaction_audit,
    op13_personal_data)}
ORACLES: dict[str, str] = {
    "op3_line_dedup": line_dedup.SQL,
    "op5_mixing": mixing.SQL,
    "op6_benchmark_decontamination": decontaminate.SQL,
    "op11_conversation_prefix_trie": prefix_trie.SQL,
    "op12_filter_interaction_audit": filter_audit.SQL,
}
