"""The registered queries of the training-data operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontam, fingerprints, html_extract, licenses, merkle, mixing, neighbour_search, ngram_join, quality, secret_scan, toxicity
from ._common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.document_paths(table(spark, sf_dir, "documents")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model).where(F.col("good_probability") >= quality.KEEP)
    return scored.select("doc_id", F.round("expected_grade", 9).alias("expected_grade"), F.round("good_probability", 9).alias("good_probability"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda key: F.crc32(key.cast("string")) % 4 == 2
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    index = toxicity.learn(docs, labels)
    scored = toxicity.score(docs, index)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "evidence", "cosines")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allot(mixing.sizes(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_preferences(chat.preference_turns(table(spark, sf_dir, "conversations")))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_search.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def queries() -> dict[str, Query]:
    every = (op1_fingerprints, op2_licenses, op3_decontamination, op4_quality, op5_toxicity, op6_html, op7_mixing, op8_chat, op9_ngram_join, op10_secrets, op11_collocations, op12_merkle, op13_nearest)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": decontam.ORACLE, "op7_mixing": mixing.ORACLE, "op8_chat": chat.ORACLE, "op9_ngram_join": ngram_join.ORACLE, "op11_collocations": collocations.ORACLE, "op12_merkle": merkle.ORACLE}
