"""Search index: postings of character n-grams and of word prefixes over chosen fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCENTS = ("àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


#: Characters of texts that a task makes tokens of, about.
CHARACTERS = 2_000_000


def _spread(fields: DataFrame) -> DataFrame:
    """Fields by key, in as many partitions as their texts need: tokens are many times a text, which files hold packed.

    What follows groups by key and more, so it needs no other shuffle, and no task gets more texts as the table grows.
    """
    size = fields.agg(F.sum(F.char_length("text"))).first()[0] or 0
    return fields.repartition(-(-size // CHARACTERS) or 1, "key")


def char_ngrams(fields: DataFrame, least: int = 3, most: int = 4) -> DataFrame:
    """(collection, key, field, token, freq, first): character n-grams of field texts, and the whole text."""
    text = F.col("text")
    n = F.char_length(text)
    runs = lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.struct((i - 1).alias("at"), F.substring(text, i, F.lit(k)).alias("token"))))
    none = F.array().cast("array<struct<at:int,token:string>>")
    parts = [F.coalesce(runs(k), none) for k in range(least, most + 1)]
    whole = F.when((n < least) | (n > most), F.array(F.struct(F.lit(0).alias("at"), text.alias("token")))).otherwise(none)
    return _postings(_spread(fields.where("text IS NOT NULL AND text <> ''")).withColumn("x", F.explode(F.concat(*parts, whole))))


def word_prefixes(fields: DataFrame, least: int = 3, most: int = 12) -> DataFrame:
    """(collection, key, field, token, freq, first): prefixes of words, lower-cased and without accents, and the words.

    Words are counted per field first, so that prefixes are made of distinct words only.
    """
    words = F.split(F.trim(F.regexp_replace(F.translate(F.lower("text"), *ACCENTS), r"[^\p{L}\p{N}]+", " ")), " ")
    each = _spread(fields.where("text IS NOT NULL")).select("collection", "key", "field", F.posexplode(words).alias("at", "word")).where("word <> ''")
    each = each.groupBy("collection", "key", "field", "word").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    size = F.char_length("word")
    lengths = F.array_distinct(F.concat(F.when(size >= least, F.sequence(F.lit(least), F.least(size, F.lit(most)))).otherwise(F.array().cast("array<int>")), F.array(size)))
    token = F.explode(F.transform(lengths, lambda k: F.substring("word", F.lit(1), k))).alias("token")
    return each.select("collection", "key", "field", "n", "at", token).groupBy("collection", "key", "field", "token").agg(F.sum("n").alias("freq"), F.min("at").alias("first"))


def text_tokens(fields: DataFrame) -> DataFrame:
    """(collection, key, field, token, freq, positions, norm) of field texts: words, lower-cased and without accents, with all their places.

    ``norm`` is the number of words of the field.
    """
    words = F.split(F.trim(F.regexp_replace(F.translate(F.lower("text"), *ACCENTS), r"[^\p{L}\p{N}]+", " ")), " ")
    rows = fields.where("text IS NOT NULL").select("collection", "key", "field", F.filter(words, lambda w: w != "").alias("words"))
    each = rows.select("collection", "key", "field", F.size("words").alias("norm"), F.posexplode("words").alias("at", "token"))
    found = each.groupBy("collection", "key", "field", "token").agg(F.count("*").alias("freq"), F.array_sort(F.collect_list("at")).alias("positions"), F.max("norm").alias("norm"))
    return found


def view(vertices: DataFrame, shown: DataFrame, collections: tuple[str, ...] | None = None) -> DataFrame:
    """Postings (analyzer, collection, key, field, token, freq, first) of a search view.

    ``vertices`` are (collection, key, field, text); ``shown`` (collection, field) names the fields of each collection,
    entries for edges (``A-B``) are skipped; ``collections`` restricts the view to some.
    """
    fields = shown.where(~F.col("collection").contains("-"))
    if collections is not None:
        fields = fields.where(F.col("collection").isin(*collections))
    rows = vertices.join(F.broadcast(fields.distinct()), ["collection", "field"])  # a handful of fields for each collection
    made = [make(rows).withColumn("analyzer", F.lit(name)) for name, make in (("n-gram", char_ngrams), ("text", word_prefixes))]
    return made[0].unionByName(made[1]).select("analyzer", "collection", "key", "field", "token", "freq", "first")


def _postings(each: DataFrame) -> DataFrame:
    return each.groupBy("collection", "key", "field", F.col("x.token").alias("token")).agg(F.count("*").alias("freq"), F.min("x.at").alias("first"))
