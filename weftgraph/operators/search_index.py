"""A stored search index: postings of words in blocks of documents, with places as differences and norms, and phrases on it.

A document is one field of one vertex. Documents are numbered in order of (collection, key, field); a block has the
postings of a word in ``BLOCK`` neighbouring numbers, so frequent words have many blocks and no row grows with the corpus.
Numbers and places are kept as differences. The index is partitioned by buckets of words: a look-up reads the buckets of its
words alone.

Defined cases: null texts, and texts without a word, are documents without postings; repeated documents are documents of
their own; words are lower-cased and lose their accents, in texts and phrases alike; phrases without a word find nothing;
repeated phrases are found once; a phrase may repeat a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators.search import ACCENTS
from weftgraph.plans.iterate import discard, step

BLOCK = 128
BUCKETS = 32


def words_of(text: Column) -> Column:
    parts = F.split(F.trim(F.regexp_replace(F.translate(F.lower(text), *ACCENTS), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.filter(F.coalesce(parts, F.array().cast("array<string>")), lambda w: w != "")


def bucket(token: str) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int").alias("bucket")


def differences(numbers: Column) -> Column:
    """A rising array as its first number and what each next one adds."""
    return F.transform(numbers, lambda x, i: x - F.when(i > 0, F.get(numbers, i - 1)).otherwise(0))


def sums(steps: Column, kind: str) -> Column:
    """The array whose ``differences`` are given."""
    start = F.array().cast(f"array<{kind}>")
    return F.aggregate(steps, start, lambda a, x: F.concat(a, F.array((F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast(kind)) + x).cast(kind))))


def write_index(fields: DataFrame, path: str) -> None:
    """Writes the index of fields (collection, key, field, text): ``path/documents`` and ``path/postings``."""
    rows = fields.select("collection", "key", "field", words_of(F.col("text")).alias("words"))
    numbered = step(rows.repartitionByRange("collection", "key", "field").sortWithinPartitions("collection", "key", "field").select(F.monotonically_increasing_id().alias("doc"), "*"))
    numbered.select("doc", "collection", "key", "field", F.size("words").alias("norm")).write.mode("overwrite").parquet(f"{path}/documents")
    each = numbered.select("doc", F.size("words").alias("norm"), F.posexplode("words").alias("place", "token"))
    # a document's words first, where they stand, then neighbouring documents
    by_doc = each.groupBy("token", "doc").agg(F.max("norm").alias("norm"), F.array_sort(F.collect_list("place")).alias("places"))
    entry = F.struct("doc", "norm", differences(F.col("places")).alias("places"))
    blocks = by_doc.groupBy("token", F.floor(F.col("doc") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(entry)).alias("x"))
    kept = blocks.select(
        bucket("token"), "token", "block", F.size("x").alias("docs"), differences(F.col("x.doc")).alias("doc"), F.col("x.norm").alias("norm"), F.col("x.places").alias("places")
    )
    kept.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    discard(numbered)


def postings(spark: SparkSession, path: str, tokens: DataFrame | None = None) -> DataFrame:
    """(token, doc, norm, places) of an index; of some tokens (token), if given."""
    rows = spark.read.parquet(f"{path}/postings")
    if tokens is not None:
        tokens = tokens.select("token").distinct()
        buckets = [r["bucket"] for r in tokens.select(bucket("token")).distinct().collect()]  # at most BUCKETS
        rows = rows.where(F.col("bucket").isin(buckets)).join(tokens, "token", "left_semi")
    each = rows.select("token", F.explode(F.arrays_zip(sums(F.col("doc"), "bigint").alias("doc"), F.col("norm"), F.col("places"))).alias("x"))
    return each.select("token", "x.doc", "x.norm", sums(F.col("x.places"), "int").alias("places"))


def phrase_search(spark: SparkSession, path: str, phrases: DataFrame) -> DataFrame:
    """(phrase, collection, key, field, n, first, score) of documents that hold the words of a phrase (phrase) one after the other.

    ``n`` is how often, ``first`` the place of the first one, ``score`` the share of the field's words that start one.
    Documents meet a phrase by its words; they are kept if they have all, and then their places are intersected, each moved
    back by its word's place in the phrase.
    """
    asked = step(phrases.select("phrase").where("phrase IS NOT NULL").distinct().select("phrase", words_of(F.col("phrase")).alias("words")).where(F.size("words") > 0))
    parts = asked.select("phrase", F.size("words").alias("size"), F.posexplode("words").alias("at", "token"))
    found = parts.join(postings(spark, path, parts), "token")
    moved = F.struct("at", F.transform("places", lambda p: p - F.col("at")).alias("starts"))
    # as many entries as the phrase has words, at most
    met = found.groupBy("phrase", "size", "doc").agg(F.max("norm").alias("norm"), F.collect_list(moved).alias("x")).where(F.size("x") == F.col("size"))
    begins = F.aggregate(F.slice("x", 2, F.greatest(F.size("x"), F.lit(1))), F.get("x.starts", F.lit(0)), lambda a, y: F.array_intersect(a, y["starts"]))
    hits = met.select("phrase", "doc", "norm", begins.alias("starts")).where(F.size("starts") > 0)
    documents = spark.read.parquet(f"{path}/documents").drop("norm")
    return hits.join(documents, "doc").select("phrase", "collection", "key", "field", F.size("starts").alias("n"), F.array_min("starts").alias("first"), (F.size("starts") / F.col("norm")).alias("score"))
