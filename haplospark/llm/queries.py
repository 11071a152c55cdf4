"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from haplospark.llm import (
    byte_bpe,
    chat,
    decontaminate,
    divergence,
    fertility,
    line_chunks,
    pages,
    scoring,
    shards,
    simhash,
    suffixes,
    token_files,
    trie,
)
from haplospark.llm.common import table
from haplospark.llm.sql import CHAT_SQL


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(turns.union(chat.planted_conversation(spark)))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(table(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_digests(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every document and test item found in it; clean documents have none."""
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_matches(documents, benchmark, "doc_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality_figures(table(spark, sf_dir, "documents"), "doc_id")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_documents(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.line_dedup_report(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_string_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_simhash_near_dedup,
        op3_html_extraction,
        op4_token_files,
        op5_byte_bpe,
        op6_sharding,
        op7_decontamination,
        op8_quality_rules,
        op9_lm_scoring,
        op10_line_dedup,
        op11_source_divergence,
        op12_conversation_trie,
        op13_suffix_array_dedup,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": CHAT_SQL,
    "op11_source_divergence": divergence.DIVERGENCE_SQL,
    "op12_conversation_trie": trie.TRIE_SQL,
}
