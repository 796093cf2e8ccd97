"""Registered training-data queries: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import decontaminate, divergence, fill_in_middle, lm_score, near_dup, packing, pii, quality_model, quality_rules, quotes, secrets, substring_dedup, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, num=85, den=100)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan_pii(table(spark, sf_dir, "documents")).drop("terms")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9 where conversations do quote: over replies derived from the same table."""
    return quotes.link_quotes(quotes.quoting_replies(table(spark, sf_dir, "conversations")))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transform(table(spark, sf_dir, "documents")))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_minhash_near_dedup": (op1, None),
    "op2_quality_classifier": (op2, None),
    "op3_decontamination": (op3, None),
    "op4_substring_dedup": (op4, None),
    "op5_quality_rules": (op5, None),
    "op6_packing": (op6, None),
    "op7_secret_scan": (op7, None),
    "op8_pii": (op8, None),
    "op9_quote_linking": (op9, quotes.SQL),
    "op10_lm_score": (op10, None),
    "op11_source_divergence": (op11, divergence.SQL),
    "op12_fill_in_middle": (op12, fill_in_middle.SQL),
    "op13_toxicity": (op13, None),
    "quote_linking_of_replies": (replies, quotes.SQL_OF_REPLIES),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
