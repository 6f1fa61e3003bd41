"""Tuples to a property graph: vertices, attributes, edges, upserts and referential integrity.

Vertices are (collection, key), attributes long rows (collection, key, attr, value), edges (collection, key, src, dst),
with ``src`` and ``dst`` as ``collection/key``. Order among tuples is (file_rank, seq); ties go by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions import terms
from weftgraph.operators.graph_query import ids_of, induced
from weftgraph.plans.iterate import step

ORDER = ("file_rank", "seq", "value")


def validate(tuples: DataFrame) -> DataFrame:
    """Adds ``problem`` to tuples (s, p, o, attr, value, arity): null if a tuple of its arity is well-formed."""
    uri = lambda c: F.coalesce(F.col(c).contains("http"), F.lit(False))
    problem = (
        F.when((F.col("arity") == 3) & ~uri("s"), "subject")
        .when((F.col("arity") == 3) & ~uri("p"), "predicate")
        .when((F.col("arity") == 5) & ~uri("s"), "subject")
        .when((F.col("arity") == 5) & ~uri("p"), "predicate")
        .when((F.col("arity") == 5) & uri("value"), "value")
    )
    return tuples.withColumn("problem", problem)


def checked(tuples: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The well-formed tuples, and the others with their ``problem``; with ``strict`` the first malformed one fails the job that reads them."""
    marked = validate(tuples)
    if strict:
        message = F.concat_ws(" ", F.lit("malformed"), "problem", F.lit("of a tuple:"), "s", "p", "o")
        marked = marked.withColumn("problem", F.when(F.col("problem").isNotNull(), F.raise_error(message).cast("string")))
    return marked.where("problem IS NULL").drop("problem"), marked.where("problem IS NOT NULL")


def vertices(triples: DataFrame, valid: tuple[str, ...], positions: tuple[str, ...] = ("s", "o")) -> DataFrame:
    """Distinct valid terms at the given positions: (collection, key)."""
    found = [terms.valid_term(F.col(c), valid) for c in positions]
    each = triples.select(F.explode(F.array(*found)).alias("t")).where("t IS NOT NULL").distinct()  # shorter than their URIs
    return each.select(F.substring_index("t", "_", 1).alias("collection"), F.substring_index("t", "_", -1).alias("key"))


def attributes(triples: DataFrame, valid: tuple[str, ...]) -> DataFrame:
    """Literal triples as (collection, key, attr, value, file_rank, seq)."""
    literal = triples.where(terms.node_kind(F.col("o")) == "literal")
    names = step(literal.select("p").distinct().select("p", terms.parse_predicate(F.col("p"))["label"].alias("attr")).where("attr IS NOT NULL"))
    parsed = _beside(literal, names).select(terms.parse_term(F.col("s"), valid).alias("t"), "attr", F.col("o").alias("value"), "file_rank", "seq")
    return parsed.where("t.is_valid").select(F.col("t.id").alias("collection"), F.col("t.number").alias("key"), "attr", "value", "file_rank", "seq")


def promoted(attrs: DataFrame) -> DataFrame:
    """All distinct values of each attribute, as a sorted array."""
    return attrs.groupBy("collection", "key", "attr").agg(F.array_sort(F.collect_set("value")).alias("values"))


def last_wins(attrs: DataFrame, keys: tuple[str, ...] = ("collection", "key", "attr")) -> DataFrame:
    """The last value of each attribute, by file and place."""
    return attrs.groupBy(*keys).agg(F.max_by("value", F.struct(*ORDER)).alias("value"))


#: Distinct predicates that are sent to all executors at most; with more, triples are shuffled by predicate.
SENT = 10_000


def predicates(triples: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(p, curie, label) of the distinct predicates of triples, parsed once each; ``labels`` (term, label) names those without a fragment."""
    found = triples.select("p").where("p IS NOT NULL").distinct().select("p", terms.parse_predicate(F.col("p")).alias("q"))
    label = F.col("q.label")
    if labels is not None:
        named = labels.select(F.col("term").alias("named_term"), F.col("label").alias("named"))
        found = found.join(named, F.col("q.term") == F.col("named_term"), "left")
        label = F.coalesce(label, F.col("named"))
    return step(found.select("p", F.col("q.curie").alias("curie"), terms.edge_label(label).alias("label")))


def _beside(triples: DataFrame, found: DataFrame) -> DataFrame:
    return triples.join(F.broadcast(found) if found.count() <= SENT else found, "p")


def edges(triples: DataFrame, valid: tuple[str, ...], labels: DataFrame | None = None) -> DataFrame:
    """Edges between valid terms, one per key, with all labels: (collection, key, src, dst, labels).

    Triples whose predicate has no label make no edge. Predicates are few: they are parsed apart and sent to the triples.
    As a key names its predicate, an edge has one label unless several predicates share a CURIE but not their label. Repeats
    go by the two terms and a number for what their predicate says, which are shorter than what is made of them.
    """
    found = predicates(triples, labels).where("label IS NOT NULL")
    said = step(found.select("curie", "label").distinct().withColumn("q", F.monotonically_increasing_id()))
    numbered = step(found.join(said, ["curie", "label"]).select("p", "q"))
    rows = _beside(triples.where(terms.node_kind(F.col("o")) == "uri").select("s", "p", "o"), numbered)
    parsed = rows.select(terms.valid_term(F.col("s"), valid).alias("a"), "q", terms.valid_term(F.col("o"), valid).alias("b"))
    # terms that aren't valid are null: a group of their own for each other end
    known = parsed.groupBy("a", "b", "q").agg(F.max(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("whole")).where("whole")
    known = known.join(F.broadcast(said) if said.count() <= SENT else said, "q")
    part = lambda c, k: F.substring_index(c, "_", k)
    each = known.select(
        F.concat_ws("-", part("a", 1), part("b", 1)).alias("collection"),
        F.concat_ws("-", part("a", -1), "curie", part("b", -1)).alias("key"),
        F.replace("a", F.lit("_"), F.lit("/")).alias("src"),
        F.replace("b", F.lit("_"), F.lit("/")).alias("dst"),
        "label",
    )
    if found.groupBy("curie").agg(F.count_distinct("label").alias("n")).where("n > 1").isEmpty():
        return each.select("collection", "key", "src", "dst", F.array("label").alias("labels"))
    return each.groupBy("collection", "key", "src", "dst").agg(F.array_sort(F.collect_set("label")).alias("labels"))


def link_rows(triples: DataFrame, valid: tuple[str, ...], labels: DataFrame | None = None) -> DataFrame:
    """(src, dst, curie, label, file_rank, seq) of links between valid terms, one row each; ``keyed`` makes edges of them."""
    found = predicates(triples, labels).where("label IS NOT NULL")
    parsed = _beside(triples.where(terms.node_kind(F.col("o")) == "uri"), found)
    a, b = terms.valid_term(F.col("s"), valid), terms.valid_term(F.col("o"), valid)
    known = parsed.select(a.alias("a"), b.alias("b"), "curie", "label", "file_rank", "seq").where("a IS NOT NULL AND b IS NOT NULL")
    return known.select(F.replace("a", F.lit("_"), F.lit("/")).alias("src"), F.replace("b", F.lit("_"), F.lit("/")).alias("dst"), "curie", "label", "file_rank", "seq")


def keyed(links: DataFrame) -> DataFrame:
    """Links (src, dst, curie, ...) with the collection and key of their edge, which their ends and CURIE say, instead of the CURIE."""
    part = lambda c, k: F.substring_index(c, "/", k)
    rest = [c for c in links.columns if c not in ("src", "dst", "curie")]
    return links.select(
        F.concat_ws("-", part("src", 1), part("dst", 1)).alias("collection"),
        F.concat_ws("-", part("src", -1), "curie", part("dst", -1)).alias("key"),
        "src",
        "dst",
        *rest,
    )


def edge_rows(triples: DataFrame, valid: tuple[str, ...], labels: DataFrame | None = None) -> DataFrame:
    """(collection, key, src, dst, label, file_rank, seq) of links between valid terms, one row each."""
    return keyed(link_rows(triples, valid, labels))


def last_label_edges(triples: DataFrame, valid: tuple[str, ...], labels: DataFrame | None = None) -> DataFrame:
    """Edges (collection, key, src, dst, label) of result tuples (file_rank, seq, s, p, o): the label of the last tuple of a key stays."""
    each = edge_rows(triples, valid, labels)
    return each.groupBy("collection", "key", "src", "dst").agg(F.max_by("label", F.struct("file_rank", "seq", "label")).alias("label"))


def with_source(edges: DataFrame) -> DataFrame:
    """Edges of ontologies with ``source``, which follows from the collection of their subject."""
    return edges.withColumn("source", terms.edge_source(F.substring_index("src", "/", 1)))


def edge_attributes(quintuples: DataFrame, edges: DataFrame, valid: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The last value of each edge attribute, and the quintuples whose edge does not exist."""
    found = predicates(quintuples).select("p", "curie")
    names = step(quintuples.select("attr").where("attr IS NOT NULL").distinct().select("attr", terms.parse_predicate(F.col("attr"))["label"].alias("name")))
    parsed = _beside(quintuples, found).join(F.broadcast(names) if names.count() <= SENT else names, "attr")
    parsed = parsed.select(terms.parse_term(F.col("s"), valid).alias("a"), "curie", terms.parse_term(F.col("o"), valid).alias("b"), F.col("name").alias("attr"), "value", "file_rank", "seq")
    each = parsed.select(
        F.concat_ws("-", "a.id", "b.id").alias("collection"),
        F.concat_ws("-", "a.number", "curie", "b.number").alias("key"),
        "attr",
        "value",
        "file_rank",
        "seq",
    )
    known = edges.select("collection", "key")
    return last_wins(each.join(known, ["collection", "key"], "left_semi")), each.join(known, ["collection", "key"], "left_anti")


def obsolete(attrs: DataFrame) -> DataFrame:
    """(collection, key) of vertices marked deprecated or labelled obsolete."""
    mark = (F.col("attr") == "deprecated") & F.col("value").contains("true") | (F.col("attr") == "label") & F.col("value").contains("obsolete")
    return attrs.where(mark).select("collection", "key").distinct()


def with_both_ends(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges whose two ends exist."""
    return induced(edges, step(ids_of(vertices)))


def upsert_vertices(old: DataFrame, new: DataFrame, update: bool = True) -> DataFrame:
    """The next version of a vertex table (collection, key, attrs map<string,array<string>>).

    New keys are inserted unless obsolete; known keys take the new attributes over theirs, or stay if ``update`` is off.
    """
    has = lambda attrs, name, text: F.coalesce(F.exists(F.element_at(attrs, name), lambda x: x.contains(text)), F.lit(False))
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, ["collection", "key"], "full_outer")
    merged = F.map_zip_with("o.attrs", "n.attrs", lambda k, a, b: F.coalesce(b, a)) if update else F.col("o.attrs")
    attrs = F.when(F.col("o.attrs").isNull(), F.col("n.attrs")).when(F.col("n.attrs").isNull(), F.col("o.attrs")).otherwise(merged)
    gone = F.col("o.attrs").isNull() & (has(F.col("n.attrs"), "deprecated", "true") | has(F.col("n.attrs"), "label", "obsolete"))
    return both.where(~gone).select("collection", "key", attrs.alias("attrs"))


def upsert_edges(old: DataFrame, new: DataFrame, vertices: DataFrame, update: bool = True) -> DataFrame:
    """The next version of an edge table (collection, key, src, dst, labels): new edges need both ends, known ones are replaced, or stay if
    ``update`` is off."""
    key = ["collection", "key"]
    inserted = with_both_ends(new.join(old, key, "left_anti"), vertices)
    if not update:
        return old.unionByName(inserted)
    replaced = new.join(old, key, "left_semi")
    return old.join(new, key, "left_anti").unionByName(replaced).unionByName(inserted)


def last_annotations(tuples: DataFrame, annotation: Column) -> DataFrame:
    """Keeps the last annotation of each subject and predicate, and everything that is none, in order of seq."""
    last = Window.partitionBy("s", "p").orderBy(F.desc("seq"))
    kept = tuples.where(annotation).withColumn("n", F.row_number().over(last)).where("n = 1").drop("n")
    return kept.unionByName(tuples.where(~annotation))


def pair_edges(edges: DataFrame) -> DataFrame:
    """Edges keyed by their ends alone: of several predicates between two vertices, the smallest key's label stays."""
    return edges.groupBy("src", "dst").agg(F.min("collection").alias("collection"), F.min_by("labels", "key").alias("labels"))


def legacy_graph(triples: DataFrame, quadruples: DataFrame, valid: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The older property graph: vertices (collection, key, term, attrs) and edges (collection, key, src, dst, label, attrs).

    Triples (seq, s, p, o) between terms are edges, keyed by their ends alone, with the first one's label; literal ones are
    attributes of their subject. Quadruples (seq, s, o, attr, value) are attributes of the edge between two terms, and make none
    themselves. All values of an attribute are kept, each once, in the order in which they came first.
    """
    listed = F.transform(F.array_sort(F.collect_list(F.struct("first", "value"))), lambda x: x["value"])

    def values(rows: DataFrame, *keys: str) -> DataFrame:
        each = rows.groupBy(*keys, "attr", "value").agg(F.min("seq").alias("first")).groupBy(*keys, "attr").agg(listed.alias("values"))
        return each.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("attr", "values")))).alias("attrs"))

    a, b = terms.valid_term(F.col("s"), valid), terms.valid_term(F.col("o"), valid)
    fragment = F.regexp_extract("p", r"([^/#]*)$", 1)
    named = triples.select("seq", a.alias("a"), b.alias("b"), fragment.alias("attr"), "o", terms.node_kind(F.col("o")).alias("kind"))
    ends = named.select(F.explode(F.array("a", "b")).alias("term")).groupBy("term").count().where("term IS NOT NULL").select("term")
    said = values(named.where("kind = 'literal' AND a IS NOT NULL AND o IS NOT NULL").select(F.col("a").alias("term"), "attr", F.col("o").alias("value"), "seq"), "term")
    split = lambda c, k: F.substring_index(c, "_", k)
    nodes = ends.join(said, "term", "left").select(split("term", 1).alias("collection"), split("term", -1).alias("key"), "term", F.coalesce("attrs", F.create_map().cast("map<string,array<string>>")).alias("attrs"))
    links = named.where("kind = 'uri'").groupBy("a", "b").agg(F.min_by("attr", F.struct("seq", "attr")).alias("label"), F.count("a").alias("n_a"), F.count("b").alias("n_b")).where("n_a > 0 AND n_b > 0")
    more = values(quadruples.select("seq", a.alias("a"), b.alias("b"), "attr", "value").where("a IS NOT NULL AND b IS NOT NULL"), "a", "b")
    found = links.join(more, ["a", "b"], "left")
    edge = found.select(
        F.concat_ws("-", split("a", 1), split("b", 1)).alias("collection"), F.concat_ws("-", split("a", -1), split("b", -1)).alias("key"),
        F.replace("a", F.lit("_"), F.lit("/")).alias("src"), F.replace("b", F.lit("_"), F.lit("/")).alias("dst"), "label", F.coalesce("attrs", F.create_map().cast("map<string,array<string>>")).alias("attrs"),
    )
    return nodes, edge
