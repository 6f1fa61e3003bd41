"""From raw documents to training sequences: quality rules, language, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and rereads it as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftgraph.llm import jaccard_join, language_id, packing, quality_rules, secrets
from weftgraph.llm.common import materialise, prepared, table
from weftgraph.llm.entry import vocabulary_path


@prepared
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the model fitted on the labelled ones among them."""
    return quality_rules.passing(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


@prepared
def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told."""
    return language_id.passing(docs, language_id.fit(docs))


@prepared
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates, the document with the smallest doc_id."""
    return jaccard_join.one_each(docs)


@prepared
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark and n_chars counted anew."""
    return secrets.redacted(docs)


@prepared
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences."""
    return packing.best_fit(docs, vocabulary_path())


STAGES = [
    ("quality rules", keep_quality),
    ("language ID", keep_language),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

#: Models are fitted and sets joined on the way, which SQL can't express; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
