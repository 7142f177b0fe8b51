"""The corpus pipeline: quality filter, exact and near duplicates, benchmark leaks, token ids.

Each stage takes the documents that the one before it kept, as a stored table, and returns those that it keeps, with the
columns of documents; the last one returns the token ids of what is left. Every stage defines what it does with null, empty and
repeated rows in the docstring of its operator; none needs doc_id to be unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tremorline.llm.bpe import encode_documents, vocabulary_path
from tremorline.llm.common import stored, table
from tremorline.llm.decontaminate import drop_leaks
from tremorline.llm.exact_dedup import drop_copies
from tremorline.llm.near_dedup import drop_near_copies
from tremorline.llm.quality import drop_poor


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_poor(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, vocabulary_path())


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("leaks", leaks), ("tokens", tokens)]

#: SQL cannot express the classifier, the edit distances or the encoding; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
