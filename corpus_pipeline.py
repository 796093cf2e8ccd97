"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all documents that its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratings_engine.config import discard, materialize
from ratings_engine.llm import decontaminate, near_dup, packing, pii, quality_model


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of documents still there."""
    return quality_model.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (five-word shingles, similarity 0.8)."""
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms are replaced in the text."""
    return pii.sanitise(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, packed into sequences of 1024."""
    return packing.pack(docs, ids=True)


STAGES = [
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", sequences),
]

#: SQL cannot express the trained classifier, the disclosure estimate or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        done = materialize(stage(spark, docs, sf_dir), name)
        discard(docs)
        docs = done
    return docs
