"""The registered queries of this subpackage: thin callers of its operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strider.llm import decontamination, jaccard_join, language_id, oracles, pieces, pii, quality_classifier, quality_rules, training_order, url_filters, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.judge(table(spark, sf_dir, "documents"))


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = training_order.materialise(table(spark, sf_dir, "documents"))
    return training_order.read_shards(spark, path)


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The public vocabulary has no scores, so this is the automaton's pass in merge order; unigram models take Viterbi."""
    return pieces.encode(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.fixity(pages, warc.damaged(pages))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op9_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


QUERIES = (
    op1_language_id, op2_training_order, op3_url_reputation, op4_quality_classifier, op5_pieces,
    op6_decontamination, op7_warc_fixity, op8_quality_rules, op9_jaccard_join, op9_jaccard_links, op10_pii,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_url_reputation": oracles.OP3, "op6_decontamination": oracles.OP6, "op9_jaccard_join": oracles.OP9}
