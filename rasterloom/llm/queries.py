"""The queries of this folder, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import binary_output, conversation_trie, decontaminate, exact_topk, language_id, near_dedup, oracles, packing, quality_rules, substring_dedup, token_counts, toxicity, url_filter, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_all(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_output.written_matrix(binary_output.pack_matrix(table(spark, sf_dir, "documents")))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_exact_topk, op2_toxicity, op3_url_filters, op4_language_id, op5_token_counts, op6_benchmark_decontamination, op7_substring_dedup, op8_packing, op9_binary_output, op10_near_dedup, op11_quality_rules, op12_conversation_trie, op13_whitening)}

ORACLES: dict[str, str] = {
    "op1_exact_topk": oracles.OP1,
    "op3_url_filters": oracles.OP3,
    "op6_benchmark_decontamination": oracles.OP6,
    "op7_substring_dedup": oracles.OP7,
    "op10_near_dedup": oracles.OP10,
    "op11_quality_rules": oracles.OP11,
    "op12_conversation_trie": oracles.OP12,
}
