"""One query per operator, over its whole table, with the columns of its contract; and DuckDB SQL where that can be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftgraph.llm import bpe, centroids, filter_audit, html_text, jaccard_join, language_id, nearest, packing, quality_classifier, quality_rules, secrets, sharding, toxicity
from weftgraph.llm.common import prepared, table


def vocabulary_path() -> str:
    """Where the public tokenizers' byte-level vocabulary lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary_path())


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary_path())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES = {f.__name__: prepared(f) for f in (op1_quality_classifier, op2_ngram_jaccard_join, op3_best_fit_packing, op4_secret_scan, op5_bpe_round_trip, op6_language_id, op7_sharding, op8_nearest_neighbours, op9_quality_rules, op10_html_extraction, op11_toxicity, op12_filter_audit, op13_centroid_clustering)}
ORACLES: dict[str, str] = {"op4_secret_scan": secrets.oracle_sql(), "op12_filter_audit": filter_audit.oracle_sql(), "op13_centroid_clustering": centroids.oracle_sql()}
