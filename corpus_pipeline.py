"""A corpus pipeline of five of the library's operators, each working on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strider.llm import decontamination, jaccard_join, pieces, pii, quality_classifier
from strider.llm.common import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Staged here, since whole texts pass through Python in small batches only
    while stage() writes."""
    return stage(quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), "quality-classifier")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the least id."""
    return jaccard_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in angle brackets; n_chars follows the text."""
    return pii.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' piece ids; staged here as in quality()."""
    return stage(pieces.encode(docs, keep=("doc_id", "lang", "source")), "SentencePiece-encoding")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("PII", without_personal_data),
    ("SentencePiece encoding", encoded),
]

#: The classifier and the encoder are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        out = step(spark, docs, sf_dir)
        docs = out if hasattr(out, "_staged_path") else stage(out, name.replace(" ", "-"))
    return docs
