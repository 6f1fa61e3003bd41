"""Names and namespaces: predicates of associations through their slots, CURIEs to URIs, and URIs to the longest namespace.

Namespaces are (prefix, uri). The longest namespace that a URI starts with is found by equality, not by comparing each URI
with each namespace: a URI is cut at every length that some namespace has, and the pieces are joined.

Defined cases: null names give null; of several namespaces with one prefix, and of several prefixes with one URI, the smallest
counts; a CURIE without a colon, and one whose prefix is unknown, is rejected with the reason; a URI that is in no namespace keeps a
null prefix; an empty namespace is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: what stands for the secure form of a base
SECURE, PLAIN = "https://purl.obolibrary.org/", "http://purl.obolibrary.org/"


def _known(namespaces: DataFrame) -> DataFrame:
    return namespaces.where("prefix IS NOT NULL AND uri <> ''").groupBy("prefix").agg(F.min("uri").alias("uri"))


def expanded(rows: DataFrame, curie: str, namespaces: DataFrame, name: str = "expanded") -> DataFrame:
    """Adds the URI of a CURIE column, null if its prefix isn't known; secure OBO bases become plain ones."""
    spaces = _known(namespaces).select(F.col("prefix").alias("_prefix"), F.col("uri").alias("_base"))
    cut = F.col(curie)
    found = rows.withColumn("_prefix", F.when(cut.contains(":"), F.substring_index(cut, ":", 1))).join(spaces, "_prefix", "left")
    uri = F.replace(F.concat("_base", F.substr(cut, F.instr(cut, ":") + 1)), F.lit(SECURE), F.lit(PLAIN))
    return found.withColumn(name, uri).drop("_prefix", "_base")


def predicates_of(associations: DataFrame, slots: DataFrame, namespaces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(association, slot, curie, predicate) of associations (association, slot), and (association, slot, curie, problem) of those without.

    A slot (slot, exact_mappings array<string>, slot_uri) gives its first exact mapping, or else its URI.
    """
    curie: Column = F.coalesce(F.get("exact_mappings", F.lit(0)), F.col("slot_uri"))
    named = slots.where("slot IS NOT NULL").select("slot", curie.alias("curie"), F.lit(True).alias("_defined"))
    rows = expanded(associations.select("association", "slot").join(named, "slot", "left"), "curie", namespaces, "predicate")
    problem = (
        F.when(F.col("slot").isNull(), "no slot")
        .when(F.col("_defined").isNull(), "no definition of the slot")
        .when(F.col("curie").isNull(), "neither mapping nor URI")
        .when(F.col("predicate").isNull(), "unknown prefix")
    )
    rows = rows.withColumn("problem", problem)
    return rows.where("problem IS NULL").select("association", "slot", "curie", "predicate"), rows.where("problem IS NOT NULL").select("association", "slot", "curie", "problem")


def contracted(rows: DataFrame, uri: str, namespaces: DataFrame) -> DataFrame:
    """Adds ``prefix`` and ``local`` of a URI column: by the longest namespace that it starts with, null if there is none."""
    spaces = namespaces.where("prefix IS NOT NULL AND uri <> ''").groupBy("uri").agg(F.min("prefix").alias("prefix"))
    lengths = sorted(r["n"] for r in spaces.select(F.char_length("uri").alias("n")).distinct().collect())  # as many as namespaces have lengths
    uris = rows.select(F.col(uri).alias("_uri")).where("_uri IS NOT NULL").distinct()
    pieces = uris.select("_uri", F.explode(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("_uri"))).alias("n"))
    met = pieces.select("_uri", "n", F.substr("_uri", F.lit(1), F.col("n")).alias("uri")).join(spaces, "uri")
    best = met.groupBy("_uri").agg(F.max_by(F.struct("prefix", "n"), "n").alias("x"))
    named = best.select("_uri", F.col("x.prefix").alias("prefix"), F.substr("_uri", F.col("x.n") + 1).alias("local"))
    return rows.join(named, rows[uri] == named["_uri"], "left").drop("_uri")
