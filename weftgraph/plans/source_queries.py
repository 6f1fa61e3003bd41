"""Registered queries of sources and datasets on the shared tables, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import terms
from weftgraph.operators import datasets as S
from weftgraph.operators import graph_query as G
from weftgraph.operators import writers as T
from weftgraph.plans.iterate import step
from weftgraph.plans.graph_queries import LINKS, PART_OF, edges, flat, graph, vertices
from weftgraph.plans.registry import register
from weftgraph.sources import derived as D
from weftgraph.sources import files

P, RDF = T.PURL, T.RDF
#: Classes that one task parses, about: they are far slower to parse than to read.
CLASSES_OF_TASK = 5_000


@register(
    "xml_classes",
    f"""SELECT '{P}PART_' || p_partkey AS s, 'http://www.w3.org/2000/01/rdf-schema#label' AS p, p_name AS o FROM part
    UNION SELECT '{P}PART_' || p_partkey, 'http://www.w3.org/2000/01/rdf-schema#subClassOf', '{P}PART_' || (p_partkey // 2) FROM part
    UNION SELECT '{P}PART_' || p_partkey, '{P}RO_0002202', '{P}PART_' || p_size FROM part WHERE p_size > 10""",
)
def xml_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as OWL classes, read again, and flattened; a restriction without filler is none."""
    resource = lambda c: F.concat(F.lit(f'rdf:resource="{P}PART_'), c.cast("string"), F.lit('"/>'))
    filler = F.when(F.col("p_size") > 10, F.concat(F.lit("<owl:someValuesFrom "), resource(F.col("p_size")))).otherwise("")
    snippet = F.concat(
        F.lit(f'<owl:Class rdf:about="{P}PART_'), "p_partkey", F.lit('"><rdfs:label>'), "p_name", F.lit("</rdfs:label><rdfs:subClassOf "), resource(F.floor(F.col("p_partkey") / 2)),
        F.lit(f'<rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="{P}RO_0002202"/>'), filler, F.lit("</owl:Restriction></rdfs:subClassOf></owl:Class>"),
    )
    part = D.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    part = part.repartition(part.count() // CLASSES_OF_TASK + 1, "p_partkey")
    # written, as filters on what is parsed would parse it again
    read = step(part.select(F.from_xml(snippet, files.CLASS_SCHEMA, {"rowTag": "owl:Class"}).alias("x"))).select("x.*")
    classes = files.classes_of(read.withColumns({"file": F.lit("part.owl"), "position": F.lit(0)}))
    spaces = spark.createDataFrame([("part.owl", [P + "PART"])], "file string, namespaces array<string>")
    return files.ontology_triples(classes, spaces)


@register("whole_ontology", f"WITH {LINKS} SELECT 'vertex' AS kind, 'TURN/' || key AS id FROM verts WHERE collection = 'TURN' UNION ALL SELECT 'edge', 'TURN-TURN/' || key FROM edges WHERE collection = 'TURN-TURN'")
def whole_ontology(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = graph(spark, sf_dir)
    some = G.ids_of(v.where("collection = 'TURN'")).orderBy("id").limit(1)
    ids, among = G.enrich(v, e, some, G.induced(e, some), {"TURN": ("all", None)})
    return ids.select(F.lit("vertex").alias("kind"), "id").union(among.select(F.lit("edge"), F.concat_ws("/", "collection", "key")))


@register("ancestor_edges_by_prefix", f"WITH RECURSIVE {LINKS}, up AS (SELECT src AS id FROM edges WHERE collection = 'TURN-TURN' UNION SELECT edges.dst FROM up JOIN edges ON edges.src = up.id AND edges.collection = 'TURN-TURN') SELECT edges.* FROM edges JOIN up ON src = id WHERE collection = 'TURN-TURN'")
def ancestor_edges_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second hierarchy label: turns of conversations, each a part of the one before."""
    e = edges(spark, sf_dir, PART_OF)
    starts = e.where("collection = 'TURN-TURN'").select(F.col("src").alias("id"))
    return flat(G.ancestors(G.hierarchy_edges(e, {"TURN": ("walk", "PART_OF")}), starts)[1])


@register("unique_list_items", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS gene FROM part WHERE p_size >= 10 UNION SELECT p_brand FROM part WHERE p_size >= 10")
def unique_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    printed = lambda items: F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))
    clusters = D.table(spark, sf_dir, "part").select(F.col("p_size").alias("clusterSize"), printed(F.split("p_name", " ")).alias("NSForest_markers"), printed(F.array("p_brand")).alias("binary_genes"))
    return S.unique_genes(clusters)


@register("dataset_merge", "SELECT coalesce(s.c_custkey, h.c_custkey) AS c_custkey, CASE WHEN s.c_custkey IS NOT NULL THEN nullif(s.c_mktsegment, 'BUILDING') ELSE h.c_mktsegment END AS segment, coalesce(nullif(s.c_name, 'Customer#000000002'), h.c_name || '!') AS name, h.c_nationkey AS nation FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0) s FULL JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) h ON s.c_custkey = h.c_custkey")
def dataset_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = D.table(spark, sf_dir, "customer")
    summary = c.where("c_custkey % 2 = 0").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.nullif("c_name", F.lit("Customer#000000002")).alias("name"))
    harvester = c.where("c_custkey % 3 <> 0").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.concat("c_name", F.lit("!")).alias("name"), F.col("c_nationkey").alias("nation"))
    return S.merged_dataset(summary, harvester, "c_custkey", ("segment",), ("name",), ("nation",))


@register("cluster_scores", "SELECT c_name AS \"clusterName\", c_custkey, n FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON o_custkey = c_custkey")
def cluster_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = D.table(spark, sf_dir, "customer")
    scores = D.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("n")).join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("author_cell_type"), "n")
    return S.with_scores(c.select(F.col("c_name").alias("clusterName"), "c_custkey"), scores, "author_cell_type")


@register("part_of_tuples", f"WITH t AS (SELECT '{P}UBERON_' || n_nationkey AS s, n_name, '{P}UBERON_' || (100 + n_regionkey) AS o FROM nation WHERE n_nationkey % 5 <> 0) SELECT 3 AS arity, s, '{P}BFO_0000050' AS p, o, NULL::VARCHAR AS attr, NULL::VARCHAR AS value FROM t UNION ALL SELECT 5, s, '{P}BFO_0000050', o, '{RDF}Source', 'HuBMAP' FROM t UNION ALL SELECT 3, s, '{RDF}Label', n_name, NULL, NULL FROM t")
def part_of_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.when(F.col("n_nationkey") % 5 == 0, "FMA:").otherwise("UBERON:")
    rows = D.table(spark, sf_dir, "nation").select(F.concat(prefix, "n_nationkey").alias("id"), F.col("n_name").alias("label"), F.array(F.concat(F.lit("UBERON:"), F.col("n_regionkey") + 100), F.concat(F.lit("FMA:"), "n_regionkey")).alias("part_of"))
    return T.part_of_tuples(rows).select("arity", "s", "p", "o", "attr", "value")


@register("cell_types_part_of", f"SELECT DISTINCT '{P}CL_' || c_custkey AS s, '{P}UBERON_' || c_nationkey AS o FROM customer JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'")
def cell_types_part_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.table(spark, sf_dir, "customer").select(F.concat(F.lit("CL:"), "c_custkey").alias("id"), F.array(F.concat(F.lit("UBERON:"), "c_nationkey")).alias("located_in"))
    known = D.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.concat(F.lit("CL:"), "o_custkey").alias("id"))
    return T.cell_type_part_of_tuples(rows, known).where("arity = 3").select("s", "o")


@register("publication_records", "SELECT user_id AS s, arg_max(printf('%.2f', value), event_id) FILTER (event_type = 'click') AS click, arg_max(printf('%.2f', value), event_id) FILTER (event_type = 'error') AS error FROM events WHERE event_type IN ('click', 'error') GROUP BY user_id")
def publication_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = D.table(spark, sf_dir, "events").select(F.col("user_id").alias("s"), F.concat(F.lit(RDF), "event_type").alias("p"), F.format_string("%.2f", "value").alias("o"), F.col("event_id").alias("seq"))
    return T.publication_record(e, ("click", "error"))


@register("association_status", "SELECT status, count(*) AS n FROM (SELECT CASE WHEN quality IS NOT NULL AND toxic IS NOT NULL AND toxic = 0 THEN 'Created' WHEN quality IS NOT NULL THEN 'Partial' ELSE 'Failed' END AS status FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY status")
def association_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.table(spark, sf_dir, "documents").join(D.table(spark, sf_dir, "labels"), "doc_id", "left")
    status = T.realised(rows, {"quality": F.col("quality"), "clean": F.when(F.col("toxic") == 0, 1)})
    return status.groupBy("status").agg(F.count("*").alias("n"))


@register(
    "schema_graph",
    """WITH s AS (SELECT n_name AS a, r_name AS b FROM nation JOIN region ON n_regionkey = r_regionkey), n AS (SELECT a AS key FROM s UNION SELECT b FROM s)
    SELECT 'vertex' AS kind, key AS a, array_to_string(list_transform(string_split(replace(lower(key), '_', ' '), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ') AS b, NULL AS label FROM n UNION ALL SELECT 'edge', a, b, 'part_of' FROM s""",
)
def schema_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = D.table(spark, sf_dir, "nation").join(D.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("subject"), F.lit("part_of").alias("predicate"), F.col("r_name").alias("object"))
    nodes, links = S.schema_graph(schema)
    return nodes.select(F.lit("vertex").alias("kind"), F.col("key").alias("a"), F.col("label").alias("b"), F.lit(None).cast("string").alias("label")).union(links.select(F.lit("edge"), "src", "dst", "label"))


@register("legacy_terms", f"SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'PART' END AS id, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS number FROM part")
def legacy_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.concat(F.when(F.col("p_partkey") % 4 == 0, F.lit(P + "GOREL_")).otherwise(F.lit(P + "PART_")), "p_partkey")
    t = terms.legacy_term(uri)
    return D.table(spark, sf_dir, "part").select("p_partkey", t["id"].alias("id"), t["number"].alias("number"))


@register("ancestor_edges_whole", f"WITH {LINKS} SELECT * FROM edges WHERE collection = 'TURN-TURN'")
def ancestor_edges_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``ancestor_edges_by_prefix``, from every turn."""
    starts = G.ids_of(vertices(spark, sf_dir), "TURN")
    return flat(G.ancestors(G.hierarchy_edges(edges(spark, sf_dir, PART_OF), {"TURN": ("walk", "PART_OF")}), starts)[1])
