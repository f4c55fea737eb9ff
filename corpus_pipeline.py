"""Corpus pipeline: quality, near duplicates, benchmark leaks, secrets, mixture.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the columns of documents; the last one
adds copies and taken. Stages are written as Parquet in the shared folder and read again, so a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spotspark.llm import decontam, mixing, ngram_join, quality, secret_scan
from spotspark.llm._common import save, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier does not reject; null and empty texts get the thresholds' own probability."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the 5-word Jaccard join at 0.75: that of least doc_id. Documents without words, and rows with a
    null doc_id, which are in no component, stay; rows that repeat the doc_id that stays are that document and stay."""
    return ngram_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text holds no benchmark passage. Each row is judged by its own text, whatever its doc_id; null texts stay."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret span replaced by a mark and n_chars made to follow; null and empty texts stay as they are."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with copies and taken (columns of these names are replaced). Null sources are one source, null
    doc_ids one id; texts without words have nothing to take and go."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", distinct_documents),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("mixture", mixture),
]

#: Fitted weights and segment costs are not expressible in SQL; tests/llm/test_llm.py compares run() with plain stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
