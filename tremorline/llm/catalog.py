"""The queries of this folder over the given tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.llm import (
    bpe,
    conversation_trie,
    decontaminate,
    exact_dedup,
    lang_id,
    lexical_search,
    line_dedup,
    near_dedup,
    ngram_join,
    pii,
    quality,
    secrets,
    sharding,
)
from tremorline.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(documents, benchmark).drop("text_hash")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents")).drop("text_hash")


def op6_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rated.drop("text_hash")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), bpe.vocabulary_path(), digests=True)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_groups(table(spark, sf_dir, "documents")).drop("text_hash")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_pii": op2_pii,
    "op3_decontaminate": op3_decontaminate,
    "op4_near_dedup": op4_near_dedup,
    "op5_sharding": op5_sharding,
    "op6_lang_id": op6_lang_id,
    "op7_quality": op7_quality,
    "op8_secrets": op8_secrets,
    "op9_line_dedup": op9_line_dedup,
    "op10_bpe": op10_bpe,
    "op11_lexical_search": op11_lexical_search,
    "op12_ngram_join": op12_ngram_join,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op5_sharding": sharding.SQL,
    "op11_lexical_search": lexical_search.SQL,
    "op12_ngram_join": ngram_join.SQL,
    "op13_conversation_trie": conversation_trie.SQL,
}
