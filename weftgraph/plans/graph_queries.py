"""Registered queries on the property graph of the shared tables, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import terms
from weftgraph.operators import graph_build as B
from weftgraph.operators import graph_query as G
from weftgraph.plans.iterate import step
from weftgraph.plans.registry import register
from weftgraph.sources import derived as D

#: The derived graph in SQL: links (rank, coll, key, src, dst, label) and literals (coll, key, attr, value).
LINKS = """links AS (
  SELECT 0 AS rank, 'NATION-REGION' AS collection, concat(n_nationkey, '-BFO:0000050-', n_regionkey) AS key, concat('NATION/', n_nationkey) AS src, concat('REGION/', n_regionkey) AS dst, 'PART_OF' AS label FROM nation
  UNION ALL SELECT 1, 'CUST-NATION', concat(c_custkey, '-RO:0001025-', c_nationkey), concat('CUST/', c_custkey), concat('NATION/', c_nationkey), 'LOCATED_IN' FROM customer
  UNION ALL SELECT 2, 'SUPP-NATION', concat(s_suppkey, '-RO:0001025-', s_nationkey), concat('SUPP/', s_suppkey), concat('NATION/', s_nationkey), 'LOCATED_IN' FROM supplier
  UNION ALL SELECT 3, 'ORD-CUST', concat(o_orderkey, '-RO:0000057-', o_custkey), concat('ORD/', o_orderkey), concat('CUST/', o_custkey), 'HAS_PARTICIPANT' FROM orders
  UNION ALL SELECT 4, 'ORD-PART', concat(l_orderkey, '-RO:0002351-', l_partkey), concat('ORD/', l_orderkey), concat('PART/', l_partkey), 'HAS_MEMBER' FROM lineitem
  UNION ALL SELECT 5, 'PART-SUPP', concat(l_partkey, '-RO:0003001-', l_suppkey), concat('PART/', l_partkey), concat('SUPP/', l_suppkey), 'PRODUCED_BY' FROM lineitem
  UNION ALL SELECT 6, 'PART-PART', concat(p_partkey, '-rdfs:subClassOf-', p_partkey // 2), concat('PART/', p_partkey), concat('PART/', p_partkey // 2), 'SUB_CLASS_OF' FROM part WHERE p_partkey > 0
  UNION ALL SELECT 7, 'TURN-TURN', concat(conv_id * 1000 + turn, '-BFO:0000050-', conv_id * 1000 + turn - 1), concat('TURN/', conv_id * 1000 + turn), concat('TURN/', conv_id * 1000 + turn - 1), 'PART_OF' FROM conversations WHERE turn > 0),
edges AS (SELECT DISTINCT collection, key, src, dst, label FROM links),
verts AS (SELECT DISTINCT split_part(id, '/', 1) AS collection, split_part(id, '/', 2) AS key FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges))"""
LITERALS = """literals AS (
  SELECT 'REGION' AS collection, CAST(r_regionkey AS VARCHAR) AS key, 'label' AS attr, r_name AS value FROM region
  UNION ALL SELECT 'NATION', CAST(n_nationkey AS VARCHAR), 'label', n_name FROM nation
  UNION ALL SELECT 'CUST', CAST(c_custkey AS VARCHAR), 'label', c_name FROM customer
  UNION ALL SELECT 'CUST', CAST(c_custkey AS VARCHAR), 'Segment', c_mktsegment FROM customer
  UNION ALL SELECT 'SUPP', CAST(s_suppkey AS VARCHAR), 'label', s_name FROM supplier
  UNION ALL SELECT 'PART', CAST(p_partkey AS VARCHAR), 'label', p_name FROM part
  UNION ALL SELECT 'PART', CAST(p_partkey AS VARCHAR), 'Brand', p_brand FROM part
  UNION ALL SELECT 'PART', CAST(p_partkey AS VARCHAR), 'Type', p_type FROM part
  UNION ALL SELECT 'ORD', CAST(o_orderkey AS VARCHAR), 'Status', o_orderstatus FROM orders)"""
#: Walks leave out edges of one collection, TURN is never entered; REGION and PART-SUPP stand for denied collections.
WALK = f"""WITH RECURSIVE {LINKS},
near AS (SELECT DISTINCT a, b FROM (SELECT src AS a, dst AS b, collection FROM edges UNION ALL SELECT dst, src, collection FROM edges)
  WHERE split_part(collection, '-', 1) <> split_part(collection, '-', 2) AND collection <> 'PART-SUPP' AND b NOT LIKE 'REGION/%')"""
WALK_ARGS = {"ignored_vertices": ("REGION",), "ignored_edges": ("PART-SUPP",)}
DEPTH = 2


def reached(depth: int) -> str:
    return f"""walk AS (SELECT concat('SUPP/', key) AS id, 0 AS depth FROM verts WHERE collection = 'SUPP'
  UNION SELECT near.b, walk.depth + 1 FROM walk JOIN near ON near.a = walk.id WHERE walk.depth < {depth}),
found AS (SELECT id, min(depth) AS depth FROM walk GROUP BY id)"""


REACHED, REACHED_WHOLE = reached(DEPTH), reached(G.MAX_DEPTH)
UP = "up AS (SELECT id FROM found WHERE id LIKE 'PART/%' UNION SELECT edges.dst FROM up JOIN edges ON edges.src = up.id AND edges.collection = 'PART-PART')"
RULES = {"PART": ("walk", "SUB_CLASS_OF"), "NATION": ("all", None), "TURN": ("walk", "PART_OF"), "SUPP": ("none", None)}


def edges(spark: SparkSession, sf_dir: str, *predicates: str) -> DataFrame:
    """Edges of all links, or of those with the given predicates; then only the tables that have them are read."""
    links = D.links(spark, sf_dir)
    return B.edges(links.where(F.col("p").isin(*predicates)) if predicates else links, D.VALID, D.predicate_labels(spark))


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.vertices(D.links(spark, sf_dir), D.VALID)


def graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges for walks, which read edges at every turn: written once. Vertices are the ends of edges here."""
    e = step(edges(spark, sf_dir))
    ends = e.select("src").union(e.select("dst")).distinct()
    return ends.select(terms.collection_of(F.col("src")).alias("collection"), terms.key_of(F.col("src")).alias("key")), e


PART_OF, SUB_CLASS_OF = terms.PURL + "BFO_0000050", terms.RDFS + "subClassOf"


def flat(edges: DataFrame) -> DataFrame:
    return edges.select("collection", "key", "src", "dst", F.array_join("labels", ",").alias("label"))


@register("graph_edges", f"WITH {LINKS} SELECT * FROM edges")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(edges(spark, sf_dir))


@register("graph_vertices", f"WITH {LINKS} SELECT * FROM verts")
def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vertices(spark, sf_dir)


@register("graph_vertices_with_predicates", f"WITH {LINKS} SELECT * FROM verts UNION SELECT split_part(term, '_', 1), split_part(term, '_', 2) FROM (SELECT unnest({list(D.PREDICATES)}) AS term)")
def graph_vertices_with_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result tuples count terms in predicate position too: those of relations here; ``subClassOf`` is no term."""
    return B.vertices(D.links(spark, sf_dir), (*D.VALID, "RO", "BFO"), ("s", "p", "o"))


@register("vertex_attributes", f"WITH {LITERALS} SELECT collection, key, attr, string_agg(DISTINCT value, '|' ORDER BY value) AS vals FROM literals WHERE value IS NOT NULL GROUP BY ALL")
def vertex_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = B.promoted(B.attributes(D.literals(spark, sf_dir), D.VALID))
    return made.select("collection", "key", "attr", F.array_join("values", "|").alias("vals"))


def events_as_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicting annotations: a user's values by event type, in order of time."""
    e = D.table(spark, sf_dir, "events")
    value = F.format_string("%.2f", "value")
    return e.select(F.lit(0).alias("file_rank"), F.col("event_id").alias("seq"), D.uri("USER", F.col("user_id").cast("string")).alias("s"), F.concat(F.lit(D.SCHEMA), "event_type").alias("p"), value.alias("o"))


@register("attributes_promoted", "SELECT 'USER' AS collection, CAST(user_id AS VARCHAR) AS key, event_type AS attr, CAST(count(DISTINCT printf('%.2f', value)) AS BIGINT) AS n, min(printf('%.2f', value)) AS least FROM events GROUP BY ALL")
def attributes_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = B.promoted(B.attributes(events_as_triples(spark, sf_dir), ("USER",)))
    return made.select("collection", "key", "attr", F.size("values").cast("long").alias("n"), F.get("values", F.lit(0)).alias("least"))


@register("attributes_last_wins", "SELECT 'USER' AS collection, CAST(user_id AS VARCHAR) AS key, event_type AS attr, arg_max(printf('%.2f', value), event_id) AS value FROM events GROUP BY ALL")
def attributes_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.last_wins(B.attributes(events_as_triples(spark, sf_dir), ("USER",)))


@register("last_annotations", "SELECT s, p, o, seq FROM (SELECT user_id AS s, event_type AS p, printf('%.2f', value) AS o, event_id AS seq, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1 OR p = 'click'")
def last_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All clicks stay; of other events the last of each user and type."""
    e = D.table(spark, sf_dir, "events").select(F.col("user_id").alias("s"), F.col("event_type").alias("p"), F.format_string("%.2f", "value").alias("o"), F.col("event_id").alias("seq"))
    return B.last_annotations(e, F.col("p") != "click")


QUINTUPLES = """each AS (SELECT concat(l_orderkey, '-RO:0002351-', l_partkey + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS key, l_linenumber AS seq, * FROM
  (SELECT *, 0 AS rank, 'Quantity' AS attr, printf('%.1f', l_quantity) AS value FROM lineitem UNION ALL SELECT *, 1, 'Return_flag', l_returnflag FROM lineitem))"""


def _edge_attributes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Whether an edge exists is asked of the links, one row each: repeats, which cost a shuffle to remove, don't matter."""
    rows = B.edge_rows(D.links(spark, sf_dir).where(F.col("p") == terms.PURL + "RO_0002351"), D.VALID, D.predicate_labels(spark))
    return B.edge_attributes(D.quintuples(spark, sf_dir), rows, D.VALID)


@register("edge_attributes_last_wins", f"WITH {LINKS}, {QUINTUPLES} SELECT 'ORD-PART' AS collection, key, attr, arg_max(value, row(rank, seq, value)) AS value FROM each SEMI JOIN edges USING (key) GROUP BY key, attr")
def edge_attributes_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edge_attributes(spark, sf_dir)[0]


@register("quintuples_without_edge", f"WITH {LINKS}, {QUINTUPLES} SELECT 'ORD-PART' AS collection, key, attr, value, CAST(rank AS INTEGER) AS file_rank, CAST(seq AS BIGINT) AS seq FROM each ANTI JOIN edges USING (key)")
def quintuples_without_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edge_attributes(spark, sf_dir)[1]


@register(
    "edge_integrity",
    f"WITH {LINKS}, {LITERALS}, kept AS (SELECT concat(collection, '/', key) AS id FROM verts WHERE collection || '/' || key NOT IN (SELECT collection || '/' || key FROM literals WHERE attr = 'label' AND value LIKE '%small%')) SELECT * FROM edges WHERE src IN (FROM kept) AND dst IN (FROM kept)",
)
def edge_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges left when vertices of a kind (here: small parts, in the place of obsolete terms) are dropped."""
    attrs = B.attributes(D.literals(spark, sf_dir), D.VALID).withColumn("value", F.replace("value", F.lit("small"), F.lit("obsolete")))
    v, e = graph(spark, sf_dir)
    return flat(B.with_both_ends(e, v.join(B.obsolete(attrs), ["collection", "key"], "left_anti")))


@register(
    "vertex_upsert",
    """WITH o AS (SELECT * FROM part WHERE p_partkey % 3 <> 0), n AS (SELECT * FROM part WHERE p_partkey % 2 = 0)
    SELECT 'PART' AS collection, CAST(coalesce(n.p_partkey, o.p_partkey) AS VARCHAR) AS key, CASE WHEN n.p_partkey IS NULL THEN o.p_name ELSE concat('new ', n.p_name) END AS label, o.p_brand AS brand, n.p_type AS kind
    FROM o FULL JOIN n ON o.p_partkey = n.p_partkey WHERE NOT (o.p_partkey IS NULL AND n.p_name LIKE '%red%')""",
)
def vertex_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New parts over old ones; red parts count as obsolete and aren't inserted, but update."""
    part = D.table(spark, sf_dir, "part")
    doc = lambda frame, attrs: frame.select(F.lit("PART").alias("collection"), F.col("p_partkey").cast("string").alias("key"), attrs.alias("attrs"))
    old = doc(part.where("p_partkey % 3 <> 0"), F.create_map(F.lit("label"), F.array("p_name"), F.lit("Brand"), F.array("p_brand")))
    label = F.concat(F.lit("new "), F.replace("p_name", F.lit("red"), F.lit("obsolete red")))
    new = doc(part.where("p_partkey % 2 = 0"), F.create_map(F.lit("label"), F.array(label), F.lit("Type"), F.array("p_type")))
    one = lambda name: F.get(F.element_at("attrs", name), F.lit(0))
    out = B.upsert_vertices(old, new)
    return out.select("collection", "key", F.replace(one("label"), F.lit("obsolete red"), F.lit("red")).alias("label"), one("Brand").alias("brand"), one("Type").alias("kind"))


@register(
    "edge_upsert",
    f"""WITH {LINKS}, o AS (SELECT * FROM edges WHERE collection = 'CUST-NATION' AND CAST(split_part(key, '-', 1) AS BIGINT) % 2 = 0),
    v AS (SELECT 'CUST/' || c_custkey AS id FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT 'NATION/' || n_nationkey FROM nation)
    SELECT collection, key, src, dst, 'NEW' AS label FROM edges WHERE collection = 'CUST-NATION' AND CAST(split_part(key, '-', 1) AS BIGINT) % 3 = 0 AND (key IN (SELECT key FROM o) OR src IN (FROM v) AND dst IN (FROM v))
    UNION ALL SELECT * FROM o WHERE CAST(split_part(key, '-', 1) AS BIGINT) % 3 <> 0""",
)
def edge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_ = edges(spark, sf_dir, terms.PURL + "RO_0001025").where("collection = 'CUST-NATION'").withColumn("number", F.substring_index("key", "-", 1).cast("long"))
    old = all_.where("number % 2 = 0").drop("number")
    new = all_.where("number % 3 = 0").drop("number").withColumn("labels", F.array(F.lit("NEW")))
    known = D.table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.lit("CUST").alias("collection"), F.col("c_custkey").cast("string").alias("key"))
    known = known.union(D.table(spark, sf_dir, "nation").select(F.lit("NATION"), F.col("n_nationkey").cast("string")))
    return flat(B.upsert_edges(old, new, known))


@register("pair_edges", f"WITH {LINKS} SELECT src, dst, min(collection) AS collection, arg_min(label, key) AS label FROM edges GROUP BY src, dst")
def pair_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older graph model, in which an edge is known by its ends alone."""
    return B.pair_edges(edges(spark, sf_dir)).select("src", "dst", "collection", F.array_join("labels", ",").alias("label"))


@register("breadth_first_search", f"{WALK}, {REACHED} SELECT id, CAST(depth AS INTEGER) AS depth FROM found")
def breadth_first_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.find(*graph(spark, sf_dir), "SUPP", DEPTH, **WALK_ARGS)[0]


@register("induced_subgraph", f"{WALK}, {REACHED} SELECT edges.* FROM edges WHERE src IN (SELECT id FROM found) AND dst IN (SELECT id FROM found)")
def induced_subgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(G.find(*graph(spark, sf_dir), "SUPP", DEPTH, **WALK_ARGS)[1])


@register(
    "distances_by_source",
    f"{WALK}, walk AS (SELECT 'NATION/' || n_nationkey AS source, 'NATION/' || n_nationkey AS id, 0 AS depth FROM nation UNION SELECT walk.source, near.b, walk.depth + 1 FROM walk JOIN near ON near.a = walk.id WHERE depth < 2) SELECT source, id, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY source, id",
)
def distances_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = graph(spark, sf_dir)
    return G.reach_each(G.adjacency(e, **WALK_ARGS), G.ids_of(v, "NATION"), 2)


@register(
    "ancestor_walk",
    f"WITH RECURSIVE {LINKS}, up AS (SELECT 'PART/' || p_partkey AS id FROM part UNION SELECT edges.dst FROM up JOIN edges ON edges.src = up.id AND edges.collection = 'PART-PART') SELECT edges.* FROM edges JOIN up ON edges.src = up.id AND edges.collection = 'PART-PART'",
)
def ancestor_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = D.table(spark, sf_dir, "part").select(F.concat(F.lit("PART/"), "p_partkey").alias("id"))
    return flat(G.ancestors(G.hierarchy_edges(edges(spark, sf_dir, SUB_CLASS_OF), {"PART": RULES["PART"]}), starts)[1])


@register(
    "enriched_subgraph",
    f"""{WALK}, walk AS (SELECT 'SUPP/' || s_suppkey AS id, 0 AS depth FROM supplier UNION SELECT near.b, walk.depth + 1 FROM walk JOIN near ON near.a = walk.id WHERE depth < 3),
    ids AS (SELECT DISTINCT id FROM walk), up AS (SELECT id FROM ids WHERE id LIKE 'PART/%' UNION SELECT edges.dst FROM up JOIN edges ON edges.src = up.id AND edges.collection = 'PART-PART')
    SELECT id FROM ids UNION SELECT id FROM up UNION SELECT 'NATION/' || key FROM verts WHERE collection = 'NATION'""",
)
def enriched_subgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = graph(spark, sf_dir)
    found = G.reach(G.adjacency(e, **WALK_ARGS), G.ids_of(v, "SUPP"), 3)
    return G.enrich(v, e, found, G.induced(e, found), RULES)[0]


@register(
    "typed_paths",
    f"WITH {LINKS} SELECT concat_ws(' ', a.src, a.dst, b.dst) AS path FROM edges a JOIN edges b ON a.dst = b.src WHERE a.collection = 'SUPP-NATION' AND b.collection = 'NATION-REGION' UNION ALL SELECT concat_ws(' ', a.src, a.dst, b.src) FROM edges a JOIN edges b ON a.dst = b.dst AND a.key <> b.key WHERE a.collection = 'SUPP-NATION' AND b.collection = 'SUPP-NATION'",
)
def typed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = step(edges(spark, sf_dir, terms.PURL + "RO_0001025", PART_OF))
    paths = G.typed_paths(e, "SUPP", ("NATION", "REGION")).union(G.typed_paths(e, "SUPP", ("NATION", "SUPP")))
    return paths.select(F.array_join("vertices", " ").alias("path"))


@register(
    "path_members",
    f"""WITH {LINKS}, p AS (SELECT a.dst AS r, a.src AS n, b.src AS c, c.src AS o FROM edges a JOIN edges b ON b.dst = a.src JOIN edges c ON c.dst = b.src WHERE a.collection = 'NATION-REGION' AND b.collection = 'CUST-NATION' AND c.collection = 'ORD-CUST')
    SELECT CAST(0 AS INTEGER) AS position, r AS id FROM p UNION SELECT 1, n FROM p UNION SELECT 2, c FROM p UNION SELECT 3, o FROM p""",
)
def path_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.path_members(edges(spark, sf_dir, PART_OF, terms.PURL + "RO_0001025", terms.PURL + "RO_0000057"), "REGION", ("NATION", "CUST", "ORD"))


@register(
    "longest_chains",
    "WITH RECURSIVE up AS (SELECT p_partkey AS start, p_partkey AS k, 0 AS n, 'PART/' || p_partkey AS chain FROM part UNION ALL SELECT start, k // 2, n + 1, chain || ' PART/' || (k // 2) FROM up WHERE k > 0) SELECT 'PART/' || start AS start, arg_max(chain, n) AS chain FROM up GROUP BY start",
)
def longest_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = D.table(spark, sf_dir, "part").select(F.concat(F.lit("PART/"), "p_partkey").alias("id"))
    chains = G.longest_chains(G.hierarchy_edges(edges(spark, sf_dir, SUB_CLASS_OF), {"PART": RULES["PART"]}), starts)
    return chains.select("start", F.array_join("chain", " ").alias("chain"))


@register("connected_components", "WITH RECURSIVE roots AS (SELECT conv_id, 'TURN/' || (conv_id * 1000) AS c FROM conversations GROUP BY conv_id HAVING max(turn) > 0) SELECT 'TURN/' || (conv_id * 1000 + turn) AS v, c FROM conversations JOIN roots USING (conv_id)")
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weftgraph.plans.iterate import components

    turns = edges(spark, sf_dir, PART_OF).where("collection = 'TURN-TURN'").select(F.col("src").alias("a"), F.col("dst").alias("b"))
    return components(turns)


@register(
    "term_functions",
    """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'CL' END AS id, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS number,
    regexp_replace(p_name || ' , ' || p_type, '[ _,/-]+', '-', 'g') AS hyphenated, 'CL:' || p_partkey AS curie, replace(upper(p_name), ' ', '_') AS label, p_name || '://x' AS plain,
    list_extract(['PCLCS', 'ENSG', 'CL'], CAST(p_partkey % 3 + 1 AS INTEGER)) AS prefix FROM part""",
)
def term_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = D.table(spark, sf_dir, "part")
    # a third part around the separator makes a term invalid; trailing separators don't
    t = terms.parse_term(F.concat(F.lit(D.PURL + "CL_"), "p_partkey", F.when(F.col("p_partkey") % 7 == 0, "_x").otherwise("_")), ("CL",))
    shaped = F.element_at(F.array(F.lit("http://x.org/pcl/CS"), F.lit("http://x.org/ensembl/ENSG"), F.lit(D.PURL + "CL_")), (F.col("p_partkey") % 3 + 1).cast("int"))
    return part.select(
        "p_partkey",
        t["id"].alias("id"),
        t["number"].alias("number"),
        terms.hyphenate(F.concat("p_name", F.lit(" , "), "p_type")).alias("hyphenated"),
        terms.purl_to_curie(F.concat(F.lit(D.PURL + "CL_"), "p_partkey")).alias("curie"),
        terms.edge_label(F.col("p_name")).alias("label"),
        F.concat("p_name", F.lit("://"), terms.without_protocols(F.lit("https://x"))).alias("plain"),
        terms.parse_term(F.concat(shaped, "p_partkey"), ("CL",))["id"].alias("prefix"),
    )


@register("tuple_rejects", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 = 1 THEN 'subject' WHEN l_linenumber % 4 = 2 THEN 'value' END AS problem, count(*) AS n FROM lineitem WHERE l_linenumber % 4 IN (1, 2) GROUP BY ALL")
def tuple_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuples of the wrong form go to a table of their own; tuples of other arities pass."""
    kind = F.col("l_linenumber") % 4
    made = D.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(kind == 1, "x").otherwise(F.lit(D.PURL + "A_1")).alias("s"),
        F.lit(D.PURL + "B_1").alias("p"),
        F.lit("o").alias("o"),
        F.lit("a").alias("attr"),
        F.when(kind == 2, "http://v").otherwise("v").alias("value"),
        F.when(kind == 2, 5).when(kind == 3, 4).otherwise(3).alias("arity"),
    )
    return B.validate(made).where("problem IS NOT NULL").groupBy("l_orderkey", "l_linenumber", "problem").agg(F.count("*").alias("n"))


# The whole walks, from all vertices of a collection and with the operator's own depth.


@register("breadth_first_search_whole", f"{WALK}, {REACHED_WHOLE} SELECT id, CAST(depth AS INTEGER) AS depth FROM found")
def breadth_first_search_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.find(*graph(spark, sf_dir), "SUPP", **WALK_ARGS)[0]


@register("induced_subgraph_whole", f"{WALK}, {REACHED_WHOLE} SELECT edges.* FROM edges WHERE src IN (SELECT id FROM found) AND dst IN (SELECT id FROM found)")
def induced_subgraph_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(G.find(*graph(spark, sf_dir), "SUPP", **WALK_ARGS)[1])


@register("enriched_subgraph_whole", f"{WALK}, {REACHED_WHOLE}, {UP} SELECT id FROM found UNION SELECT id FROM up UNION SELECT 'NATION/' || key FROM verts WHERE collection = 'NATION'")
def enriched_subgraph_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = graph(spark, sf_dir)
    return G.enrich(v, e, *G.find(v, e, "SUPP", **WALK_ARGS), RULES)[0]


@register("ancestor_walk_whole", f"WITH {LINKS} SELECT * FROM edges WHERE collection = 'PART-PART'")
def ancestor_walk_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = G.ids_of(vertices(spark, sf_dir), "PART")
    return flat(G.ancestors(G.hierarchy_edges(edges(spark, sf_dir, SUB_CLASS_OF), {"PART": RULES["PART"]}), starts)[1])


@register("longest_chains_whole", f"WITH RECURSIVE {LINKS}, up AS (SELECT key AS start, CAST(key AS BIGINT) AS k, 0 AS n, 'PART/' || key AS chain FROM verts WHERE collection = 'PART' UNION ALL SELECT start, k // 2, n + 1, chain || ' PART/' || (k // 2) FROM up WHERE k > 0) SELECT 'PART/' || start AS start, arg_max(chain, n) AS chain FROM up GROUP BY start")
def longest_chains_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = G.ids_of(vertices(spark, sf_dir), "PART")
    chains = G.longest_chains(G.hierarchy_edges(edges(spark, sf_dir, SUB_CLASS_OF), {"PART": RULES["PART"]}), starts)
    return chains.select("start", F.array_join("chain", " ").alias("chain"))
