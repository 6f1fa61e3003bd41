"""Registered queries of files, look-ups, writers and reports that write tables or files derived from the shared tables and
read them again, with DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import terms
from weftgraph.operators import datasets as S
from weftgraph.operators import graph_build as B
from weftgraph.operators import graph_query as G
from weftgraph.operators import legacy as O
from weftgraph.operators import lookups as L
from weftgraph.operators import reports as R
from weftgraph.operators import search as X
from weftgraph.operators import sinks
from weftgraph.operators import transforms as V
from weftgraph.operators import writers as T
from weftgraph.plans.graph_queries import LINKS, LITERALS, REACHED, RULES, WALK, WALK_ARGS, DEPTH, edges, flat, graph
from weftgraph.plans.iterate import shared_folder
from weftgraph.plans.registry import register
from weftgraph.sources import derived as D
from weftgraph.sources import files
from weftgraph.streaming import ingest

P, RDF, RDFS = T.PURL, T.RDF, terms.RDFS


def folder(spark: SparkSession) -> str:
    """A new folder beside the steps' tables."""
    return f"{shared_folder(spark)}/weftgraph-files-{uuid.uuid4().hex}"


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ---- ontologies


def owl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as OWL classes, one line each, in an ontology with a header."""
    name = F.concat(F.lit("<rdfs:label>"), "s_name", F.lit("</rdfs:label>"))
    parent = F.concat(F.lit(f'<rdfs:subClassOf rdf:resource="{P}SUPP_'), F.floor(F.col("s_suppkey") / 2), F.lit('"/>'))
    other = F.concat(F.lit(f'<rdfs:seeAlso rdf:resource="{P}NATION_'), "s_nationkey", F.lit('"/>'))
    number = F.concat(F.lit("<obo:IAO_0000115>00"), "s_suppkey", F.lit("</obo:IAO_0000115><skos:note>none</skos:note>"))
    about = F.concat(F.lit(f'<owl:Class rdf:about="{P}SUPP_'), "s_suppkey", F.lit('">'))
    classes = D.table(spark, sf_dir, "supplier").select(F.concat(about, name, parent, other, number, F.lit("</owl:Class>")).alias("value"))
    spaces = 'xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:obo="http://purl.obolibrary.org/obo/" xmlns:skos="http://www.w3.org/2004/02/skos/core#"'
    head = D.table(spark, sf_dir, "region").where("r_regionkey = 0").select(F.concat(F.lit(f'<rdf:RDF {spaces}>\n<owl:Ontology rdf:about="{P}supp.owl"><dc:title>'), "r_name", F.lit(f'</dc:title><owl:versionInfo>of 2024-05-06</owl:versionInfo><obo:IAO_0000700 rdf:resource="{P}SUPP_0"/></owl:Ontology>')).alias("value"))
    return head.union(classes).union(head.select(F.lit("</rdf:RDF>")))


@register(
    "ontology_statements",
    f"""SELECT '{P}SUPP_' || s_suppkey AS s, '{RDFS}label' AS p, s_name AS o FROM supplier UNION SELECT '{P}SUPP_' || s_suppkey, '{RDFS}subClassOf', '{P}SUPP_' || (s_suppkey // 2) FROM supplier
    UNION SELECT '{P}SUPP_' || s_suppkey, '{P}IAO_0000115', '00' || s_suppkey FROM supplier""",
)
def ontology_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All literals and named objects of classes of an ontology file, under kept predicates; resources of other namespaces are left out."""
    path = folder(spark)
    sinks.write_lines(owl_lines(spark, sf_dir).coalesce(1), "value", path)
    classes = files.ontology_classes(spark, path)
    spaces = files.root_namespaces(classes, files.ontology_headers(spark, path))
    return files.statement_triples(files.ontology_statements(spark, path), files.prefixes(spark, path), spaces)


@register("ontology_header", f"SELECT r_name AS title, '{P}supp.owl' AS purl, '2024-05-06' AS version, '{P}SUPP_0' AS root FROM region WHERE r_regionkey = 0")
def ontology_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    sinks.write_lines(owl_lines(spark, sf_dir).coalesce(1), "value", path)
    return files.ontology_headers(spark, path).select("title", "purl", "version", "root")


@register("ontology_terms", f"SELECT 'SUPP_' || s_suppkey AS term, '{P}SUPP_' || s_suppkey AS purl, s_name AS label FROM supplier")
def ontology_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    sinks.write_lines(owl_lines(spark, sf_dir).coalesce(1), "value", path)
    return files.term_labels(files.ontology_terms(spark, path))


@register(
    "relation_labels",
    f"""SELECT 'PART_' || (p_partkey // 3) AS term, '{P}PART_' || (p_partkey // 3) AS purl, arg_max(p_name, p_partkey) AS label FROM part GROUP BY p_partkey // 3
    UNION ALL SELECT unnest(['RO_0002027', 'RO_0002294', 'RO_0020325', 'IAO_0000136']), '{P}' || unnest(['RO_0002027', 'RO_0002294', 'RO_0020325', 'IAO_0000136']), unnest(['has pharmacological effect', 'selectively express', 'evaluated in', 'is about'])""",
)
def relation_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several elements with one term the last label counts; a file of relations brings fixed ones."""
    part = D.table(spark, sf_dir, "part")
    rows = part.select(F.lit("ro.owl").alias("file"), F.col("p_partkey").alias("position"), F.concat(F.lit(f"{P}PART_"), F.floor(F.col("p_partkey") / 3)).alias("about"), F.col("p_name").alias("label"))
    return files.term_labels(rows)


@register("ontology_ids", "SELECT p_brand AS file, string_agg(DISTINCT p_mfgr, ',' ORDER BY p_mfgr) AS ids FROM (SELECT p_brand, 'T' || (p_size % 7) AS p_mfgr FROM part) GROUP BY p_brand")
def ontology_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    about = F.concat(F.lit(f"{P}T"), F.col("p_size") % 7, F.lit("_"), "p_partkey")
    rows = D.table(spark, sf_dir, "part").select(F.col("p_brand").alias("file"), about.alias("about"))
    return files.term_ids(rows.union(rows.select("file", F.lit(f"{P}valid_1")))).select("file", F.array_join("ids", ",").alias("ids"))


@register(
    "ontology_namespaces",
    f"""WITH c AS (SELECT n_regionkey, n_nationkey, '{P}N' || (n_nationkey % 4) AS space FROM nation), r AS (SELECT n_regionkey, CASE WHEN n_regionkey % 2 = 0 THEN '{P}N1' ELSE arg_min(space, n_nationkey) END AS root FROM c GROUP BY n_regionkey)
    SELECT DISTINCT n_regionkey || '.owl' AS file, space AS namespace, space = root AS is_root FROM c JOIN r USING (n_regionkey)""",
)
def ontology_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Namespaces of each file's classes, that of its root - or else of its first class - marked."""
    nation = D.table(spark, sf_dir, "nation")
    name = F.concat("n_regionkey", F.lit(".owl"))
    classes = nation.select(name.alias("file"), F.col("n_nationkey").alias("position"), F.concat(F.lit(f"{P}N"), F.col("n_nationkey") % 4, F.lit("_"), "n_nationkey").alias("about"))
    headers = nation.select(name.alias("file"), F.when(F.col("n_regionkey") % 2 == 0, f"{P}N1_0").alias("root")).distinct()
    return files.class_namespaces(classes, files.root_namespaces(classes, headers))


@register("taxon_slim", "SELECT p_brand || '.owl' AS file, count(*) AS kept FROM part WHERE p_size = 7 GROUP BY p_brand")
def taxon_slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    restriction = F.array(F.struct(F.lit("in taxon").alias("property"), F.concat(F.lit("taxon"), "p_size").alias("filler")))
    classes = D.table(spark, sf_dir, "part").select(F.concat("p_brand", F.lit(".owl")).alias("file"), F.col("p_name").alias("about"), restriction.alias("restrictions"))
    none = classes.limit(0)
    return files.slimmed(classes, none, none, "taxon7")[3]


# ---- files


@register("csv_tables", "SELECT n_name AS \"clusterName\", CAST(n_nationkey AS BIGINT) AS \"clusterSize\", length(n_name) > 0 AS has_id FROM nation UNION ALL SELECT r_name, NULL, NULL FROM region")
def csv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a leading index column, whose missing ids are made, and another one with fewer columns, read together."""
    one, other = folder(spark), folder(spark)
    D.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_c0"), F.col("n_name").alias("clusterName"), F.col("n_nationkey").alias("clusterSize")).write.option("header", True).csv(one)
    D.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("_c0"), F.col("r_name").alias("clusterName")).write.option("header", True).csv(other)
    table = files.result_table(spark, one, "_c0 string, clusterName string, clusterSize long")
    rest = files.combined_csv(spark, [one, other]).where("clusterSize IS NULL").select("clusterName", F.lit(None).cast("long").alias("clusterSize"), F.lit(None).cast("boolean").alias("has_id"))
    return table.select("clusterName", "clusterSize", (F.length("uuid") == 12).alias("has_id")).unionByName(rest)


@register("tuple_files", "SELECT CAST(n_nationkey AS BIGINT) AS seq, CASE WHEN n_nationkey % 3 = 0 THEN 5 ELSE 3 END AS arity, 's' || n_nationkey AS s, 'p' AS p, n_name AS o, CASE WHEN n_nationkey % 3 = 0 THEN 'a' END AS attr, CASE WHEN n_nationkey % 3 = 0 THEN n_comment END AS value FROM (SELECT *, n_name || '\"\\' AS n_comment FROM nation)")
def tuple_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    five = F.col("n_nationkey") % 3 == 0
    rows = D.table(spark, sf_dir, "nation").select(F.lit("f").alias("file"), F.col("n_nationkey").alias("seq"), F.concat(F.lit("s"), "n_nationkey").alias("s"), F.lit("p").alias("p"), F.col("n_name").alias("o"), F.when(five, "a").alias("attr"), F.when(five, F.concat("n_name", F.lit('"\\'))).alias("value"))
    sinks.write_tuples(rows, path)
    return files.tuple_files(spark, path).select("seq", "arity", "s", "p", "o", "attr", "value")


@register("written_graph", f"WITH {LINKS} SELECT collection, src, dst FROM edges WHERE collection IN ('NATION-REGION', 'CUST-NATION') UNION ALL SELECT 'vertex', 'CUST/' || c_custkey, c_name FROM customer")
def written_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices and edges written by collection and read again; system fields are hidden."""
    path = folder(spark)
    attrs = F.create_map(F.lit("label"), F.array("c_name"), F.lit("_rev"), F.array(F.lit("1")))
    v = D.table(spark, sf_dir, "customer").select(F.lit("CUST").alias("collection"), text("c_custkey").alias("key"), attrs.alias("attrs"))
    e = edges(spark, sf_dir, P + "BFO_0000050", P + "RO_0001025").where("collection IN ('NATION-REGION', 'CUST-NATION')")
    sinks.write_graph(v, e, path)
    v, e = files.graph_tables(spark, path)
    label = F.when(F.size("attrs") == 1, F.get(F.element_at("attrs", "label"), F.lit(0)))
    return e.select("collection", "src", "dst").union(v.select(F.lit("vertex"), F.concat_ws("/", "collection", "key"), label))


@register("tsv_nodes", "SELECT 'CUST' AS collection, CAST(c_custkey AS VARCHAR) AS key, 'Segment=' || c_mktsegment || ';label=' || c_name || '|x' AS attributes FROM customer")
def tsv_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    attrs = F.create_map(F.lit("label"), F.array(F.col("c_name"), F.lit("x")), F.lit("Segment"), F.array("c_mktsegment"))
    v = D.table(spark, sf_dir, "customer").select(F.lit("CUST").alias("collection"), text("c_custkey").alias("key"), attrs.alias("attrs"))
    sinks.write_tsv(sinks.node_table(v), path)
    return sinks.routed(sinks.read_tsv(spark, path, "id string, category string, attributes string")).select("collection", "key", "attributes")


@register("tsv_edges", f"WITH {LINKS} SELECT replace(src, '/', ':') AS subject, label AS predicate, replace(dst, '/', ':') AS object FROM edges WHERE collection = 'ORD-CUST'")
def tsv_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    sinks.write_tsv(sinks.edge_table(edges(spark, sf_dir, P + "RO_0000057")), path)
    return sinks.read_tsv(spark, path, "subject string, predicate string, object string")


@register("n_triples", f"WITH {LINKS} SELECT '<b/' || replace(src, '/', '_') || '> <b/' || label || '> <b/' || replace(dst, '/', '_') || '> .' AS value FROM edges WHERE collection = 'SUPP-NATION' UNION ALL SELECT '<b/SUPP_' || s_suppkey || '> <b/label> \"' || s_name || '\" .' FROM supplier")
def n_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    v = D.table(spark, sf_dir, "supplier").select(F.lit("SUPP").alias("collection"), text("s_suppkey").alias("key"), F.create_map(F.lit("label"), F.array("s_name")).alias("attrs"))
    e = edges(spark, sf_dir, P + "RO_0001025").where("collection = 'SUPP-NATION'")
    sinks.write_lines(sinks.n_triples(e, "b/").union(sinks.attribute_triples(v, "b/")), "value", path)
    return spark.read.text(path)


@register("label_lines", "SELECT DISTINCT p_type || ': ' || replace(upper(p_type), ' ', '_') AS value FROM part")
def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    sinks.write_lines(sinks.label_lines(D.table(spark, sf_dir, "part").select(F.col("p_type").alias("label"))), "value", path)
    return spark.read.text(path)


@register("obsolete_lines", "SELECT 'first' AS load, 'PART_' || p_partkey AS term FROM part WHERE p_name LIKE '%red%'")
def obsolete_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of obsolete vertices (here: red parts), written apart for each load."""
    path = folder(spark)
    part = D.table(spark, sf_dir, "part").where(F.col("p_name").contains("red"))
    attrs = part.select(F.lit("PART").alias("collection"), text("p_partkey").alias("key"), F.lit("label").alias("attr"), F.concat(F.lit("obsolete "), "p_name").alias("value"))
    sinks.obsolete_terms(B.obsolete(attrs), "first").write.partitionBy("load").parquet(path)
    return spark.read.schema("term string, load string").parquet(path).select("load", "term")


@register("keyed_json_files", "SELECT 'n' || n_nationkey AS id, n_name AS name FROM nation")
def keyed_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads by id in JSON files that also list the ids under a key of their own."""
    path = folder(spark)
    nation = D.table(spark, sf_dir, "nation")
    by_id = F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("n"), "n_nationkey"), F.struct(F.col("n_name").alias("name")))))
    body = nation.groupBy("n_regionkey").agg(F.to_json(by_id).alias("j"), F.to_json(F.collect_list(F.concat(F.lit("n"), "n_nationkey"))).alias("ids"))
    lines = body.select(F.concat(F.expr("left(j, length(j) - 1)"), F.lit(', "ids": '), "ids", F.lit("}")).alias("value"))
    lines.repartition(5, "value").write.option("maxRecordsPerFile", 1).text(path)
    return files.keyed_json(spark, path, "ids").select("id", F.try_variant_get("payload", "$.name", "string").alias("name"))


@register("written_collection", "SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS label FROM customer")
def written_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    read = lambda name, kind, key, label: D.table(spark, sf_dir, name).select(F.lit(kind).alias("collection"), text(key).alias("key"), F.col(label).alias("label"))
    both = read("customer", "CUST", "c_custkey", "c_name").union(read("supplier", "SUPP", "s_suppkey", "s_name"))
    sinks.write_collection(both, "CUST", path)
    return spark.read.schema("key string, label string").json(path)


@register("ingested_stream", "SELECT 'USER' AS collection, CAST(user_id AS VARCHAR) AS key, event_type AS attr, arg_max(printf('%.2f', value), event_id) AS value FROM events GROUP BY user_id, event_type")
def ingested_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuple files taken in by a stream, one micro-batch a file, equal one batch over all."""
    source, out, checkpoint = folder(spark), folder(spark), folder(spark)
    value = F.format_string("%.2f", "value")
    rows = D.table(spark, sf_dir, "events").select(F.lit(0).alias("file_rank"), F.col("event_id").alias("seq"), F.lit("USER").alias("collection"), text("user_id").alias("key"), F.col("event_type").alias("attr"), value.alias("value"))
    rows.repartition(3, "seq").write.parquet(source)
    ingest.ingest(spark, source, out, checkpoint).awaitTermination()
    return ingest.current(spark, out).select("collection", "key", "attr", "value")


# ---- result files of datasets


@register("dataset_companions", "SELECT 'd/b' || p_partkey || '_results.csv' AS path, 'scores' AS role, 'd/b' || p_partkey || '_scores.csv' AS companion FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT 'd/b' || p_partkey || '_results.csv', 'summary', 'd/b' || p_partkey || '_x_summary.csv' FROM part WHERE p_partkey % 2 = 0")
def dataset_companions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that the name of a result file leads to."""
    part = D.table(spark, sf_dir, "part")
    path = lambda tail: F.concat(F.lit("d/b"), "p_partkey", F.lit(tail)).alias("path")
    listed = part.select(path("_results.csv")).union(part.where("p_partkey % 3 <> 0").select(path("_scores.csv"))).union(part.where("p_partkey % 2 = 0").select(path("_x_summary.csv")))
    found = S.companions(listed, "_results.csv$", {"scores": ("_results", "_scores"), "summary": ("_results", "_*_summary")})
    return found.select("path", "role", F.explode("companions").alias("companion"))


@register("dataset_versions", "SELECT p_partkey AS file, CASE p_partkey % 3 WHEN 0 THEN 'a' || p_partkey || ',b' WHEN 1 THEN 'v' || p_partkey END AS ids, CASE WHEN p_partkey % 3 = 2 THEN 'no dataset version in dataset_version_id or h5ad_url' END AS problem FROM part")
def dataset_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_partkey") % 3
    rows = D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("file"), F.when(kind == 0, F.concat(F.lit("a"), "p_partkey", F.lit("--b"))).otherwise("").alias("dataset_version_id"), F.when(kind == 1, F.concat(F.lit("https://x/v"), "p_partkey", F.lit(".h5ad"))).alias("h5ad_url"))
    return S.version_ids(rows).join(S.without_version(rows), "file", "left").select("file", F.array_join("ids", ",").alias("ids"), "problem")


@register("harvester_rows", "SELECT c_custkey, n_name AS name FROM customer LEFT JOIN (SELECT n_regionkey, arg_min(n_name, n_nationkey) AS n_name FROM nation GROUP BY n_regionkey) ON n_regionkey = c_nationkey % 7")
def harvester_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    harvester = D.table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("dataset_version_id"), F.col("n_nationkey").alias("row_no"), F.col("n_name").alias("name"))
    rows = D.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") % 7).alias("dataset_version_id"))
    return S.with_harvester(rows, harvester).select("c_custkey", "harvester.name")


@register("stale_inputs", "SELECT o_orderkey AS path FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 3 = 1 AND o_orderdate < DATE '1995-01-01'")
def stale_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = D.table(spark, sf_dir, "orders")
    inputs = o.select(F.col("o_orderkey").alias("path"), F.lit("1995-01-01").cast("date").alias("modified"))
    manifest = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("path"), F.when(F.col("o_orderkey") % 3 == 1, F.col("o_orderdate")).otherwise(F.lit("2000-01-01").cast("date")).cast("date").alias("made"))
    return S.stale(inputs, manifest)


# ---- look-ups


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in the place of genes: a name may have several ids, and an id several names."""
    part = D.table(spark, sf_dir, "part")
    rows = part.select(F.col("p_partkey").alias("row_no"), F.col("p_name").alias("external_gene_name"), F.concat(F.lit("ENSG"), F.floor(F.col("p_partkey") / 2)).alias("ensembl_gene_id"), F.when(F.col("p_partkey") % 10 > 0, F.concat("p_size", F.lit(".0"))).alias("entrezgene_id"))
    return files.gene_mapping(rows)


MAPPING = "m AS (SELECT min(p_partkey) AS row_no, p_name AS name, 'ENSG' || (p_partkey // 2) AS ensembl, CAST(p_size AS VARCHAR) AS entrez FROM part WHERE p_partkey % 10 > 0 GROUP BY ALL)"


@register(
    "gene_lookups",
    f"WITH {MAPPING}, p AS (SELECT 'name_to_ensembl' AS map, name AS key, ensembl AS v, row_no FROM m UNION ALL SELECT 'ensembl_to_name', ensembl, name, row_no FROM m UNION ALL SELECT 'name_to_entrez', name, entrez, row_no FROM m UNION ALL SELECT 'entrez_to_name', entrez, name, row_no FROM m) SELECT map, key, string_agg(v, '|' ORDER BY row_no, v) AS vals FROM p GROUP BY map, key",
)
def gene_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, table in L.gene_maps(mapping(spark, sf_dir)).items():
        made = table.select(F.lit(name).alias("map"), "key", F.array_join("values", "|").alias("vals"))
        out = made if out is None else out.union(made)
    return out


@register("gene_ids_of_names", f"WITH {MAPPING} SELECT DISTINCT id FROM (SELECT arg_min(ensembl, row_no) AS id FROM m GROUP BY name UNION ALL SELECT 'ENSG' || s_suppkey FROM supplier)")
def gene_ids_of_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = D.table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).union(D.table(spark, sf_dir, "supplier").select(F.concat(F.lit("ENSG"), "s_suppkey", F.lit(".4"))))
    return L.ids_of_names(names.distinct(), mapping(spark, sf_dir), "ensembl")


@register("protein_terms", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'PR_' || acc ELSE 'PR_Q' || c_custkey END AS protein_term FROM customer LEFT JOIN (SELECT p_size AS k, arg_min('A' || p_partkey, p_partkey) AS acc FROM part GROUP BY p_size) ON k = c_custkey % 60")
def protein_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_no"), F.concat(F.lit("ENSP"), "p_size").alias("ensp"), F.concat(F.lit("A"), "p_partkey").alias("accession"))
    ident = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("ENSP"), F.col("c_custkey") % 60)).otherwise(F.concat(F.lit("Q"), "c_custkey"))
    return O.protein_terms(D.table(spark, sf_dir, "customer").select("c_custkey", ident.alias("id")), "id", table).select("c_custkey", "protein_term")


@register("protein_lookups", "SELECT 'ENSP' || p_size AS key, string_agg('A' || p_partkey, '|' ORDER BY p_partkey) AS vals FROM part GROUP BY p_size UNION ALL SELECT 'A' || p_partkey, 'ENSP' || p_size FROM part")
def protein_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_no"), F.concat(F.lit("ENSP"), "p_size").alias("ensp"), F.concat(F.lit("A"), "p_partkey").alias("accession"))
    one, other = L.protein_maps(table).values()
    return one.union(other).select("key", F.array_join("values", "|").alias("vals"))


@register("gene_records", "SELECT c_custkey, n_name AS protein, 'l' || n_nationkey AS link FROM customer LEFT JOIN nation ON n_nationkey = c_custkey % 40")
def gene_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    genes = D.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("Gene_ID"), F.col("n_name").alias("UniProt_name"), F.concat(F.lit("l"), "n_nationkey").alias("Link_to_UniProt_ID"))
    rows = D.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 40).alias("entrez"))
    return L.with_gene_records(rows, genes).select("c_custkey", "protein", "link")


@register("accessions", "SELECT DISTINCT p_brand AS accession FROM part WHERE p_size > 5")
def accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.accessions(D.table(spark, sf_dir, "part").select(F.when(F.col("p_size") > 5, F.col("p_brand")).otherwise("").alias("UniProt_name")))


# ---- writers


@register(
    "dataset_publications",
    f"""WITH c AS (SELECT *, '{P}CSD_' || c_custkey AS csd, '{P}PUB_' || c_custkey AS pub, c_mktsegment || ' et al.' AS cit FROM customer)
    SELECT 3 AS arity, csd AS s, '{T.DC}source' AS p, pub AS o, NULL::VARCHAR AS attr, NULL::VARCHAR AS value FROM c UNION ALL SELECT 5, csd, '{T.DC}source', pub, '{RDF}Source', 'CELLxGENE' FROM c
    UNION ALL SELECT 3, csd, '{RDF}dataset_name', c_name, NULL, NULL FROM c UNION ALL SELECT 3, csd, '{RDF}cell_count', CAST(c_nationkey AS VARCHAR), NULL, NULL FROM c UNION ALL SELECT 3, csd, '{RDF}cellxgene_dataset', 'x/' || c_custkey, NULL, NULL FROM c
    UNION ALL SELECT 3, pub, '{RDF}title', c_mktsegment, NULL, NULL FROM c UNION ALL SELECT 3, pub, '{RDF}publication_doi', 'doi.org/' || c_custkey, NULL, NULL FROM c
    UNION ALL SELECT 3, csd, '{RDF}Citation', cit, NULL, NULL FROM c WHERE c_custkey % 2 = 0 UNION ALL SELECT 3, pub, '{RDF}Citation', cit, NULL, NULL FROM c WHERE c_custkey % 2 = 0""",
)
def dataset_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    given = {"Dataset_name": F.col("c_name"), "Number_of_cells": F.col("c_nationkey"), "Link_to_CELLxGENE_dataset": F.concat(F.lit("https://x/"), "c_custkey"), "Title": F.col("c_mktsegment")}
    citation = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_mktsegment", F.lit(" et al."))).otherwise("")
    fields = [given.get(c, none).alias(c) for c in (*T.DATASET_FIELDS, *T.PUBLICATION_FIELDS)]
    rows = D.table(spark, sf_dir, "customer").select(text("c_custkey").alias("id"), F.concat(F.lit("https://doi.org/"), "c_custkey").alias("Link_to_publication"), citation.alias("Citation"), *fields)
    return T.dataset_tuples(rows).select("arity", "s", "p", "o", "attr", "value")


@register("protein_annotations", f"SELECT '{P}PR_S' || s_suppkey AS s, '{RDF}label' AS p, s_name AS o FROM supplier UNION ALL SELECT '{P}PR_S' || s_suppkey, '{RDF}number_of_amino_acids', CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_nationkey > 3")
def protein_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    given = {"Protein_name": F.col("s_name"), "Number_of_amino_acids": F.when(F.col("s_nationkey") > 3, F.col("s_nationkey"))}
    rows = D.table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("accession"), *[given.get(c, none).alias(c) for c in T.PROTEIN_FIELDS])
    return T.protein_tuples(rows).select("s", "p", "o")


@register(
    "all_writers",
    f"""WITH a AS (SELECT 0 AS rank, '{P}PR_' || s_nationkey AS s, '{RDF}label' AS p, s_name AS o FROM supplier UNION ALL SELECT 1, '{P}PR_' || c_nationkey, '{RDF}label', c_name FROM customer WHERE c_nationkey % 2 = 0)
    SELECT s, p, arg_max(o, row(rank, o)) AS o FROM a GROUP BY s, p UNION ALL SELECT DISTINCT '{P}GS_' || c_mktsegment, '{P}RO_0003000', '{P}PR_' || c_nationkey FROM customer""",
)
def all_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuples of several writers in one table, of a subject's annotations the last writer's; relations once."""
    none = F.lit(None).cast("string")
    one = lambda name, key, label: D.table(spark, sf_dir, name).select(text(key).alias("accession"), *[(F.col(label) if c == "Protein_name" else none).alias(c) for c in T.PROTEIN_FIELDS])
    genes = T.gene_tuples(D.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("symbol"), text("c_nationkey").alias("protein")))
    made = T.in_order(T.protein_tuples(one("supplier", "s_nationkey", "s_name")), T.protein_tuples(one("customer", "c_nationkey", "c_name").where("CAST(accession AS INT) % 2 = 0")), genes)
    return T.deduplicated(made).where("arity = 3").select("s", "p", "o")


@register("association_catalogue", "SELECT o_orderstatus AS association, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY o_orderstatus UNION ALL SELECT 'GeneProducesProtein', count(*) FROM orders WHERE o_orderkey % 2 = 1")
def association_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Associations with their predicate; those that the catalogue lacks are rejects."""
    name = F.when(F.col("o_orderkey") % 2 == 1, "GeneProducesProtein").otherwise(F.col("o_orderstatus"))
    good, rejects = T.resolved(D.table(spark, sf_dir, "orders").select(name.alias("association")), T.catalogue(spark))
    good = good.where(F.col("predicate") == P + "RO_0003000").groupBy("association").agg(F.count("*").alias("n"))
    return good.union(rejects.groupBy("association").agg(F.count("*").alias("n")))


@register(
    "entity_terms",
    """SELECT p_partkey, 'GS_' || p_name AS gene, 'CS_' || replace(p_name, ' ', '-') || '-u' AS cell_set, CASE WHEN p_partkey % 2 = 0 THEN 'CHEMBL_' || p_partkey ELSE 'DRUG_' || p_name END AS drug, CASE WHEN p_partkey % 3 = 0 THEN 'PUB_d' ELSE 'PUB_doi' END AS publication,
    'NCT_' || p_partkey AS trial, 'RS_' || p_partkey AS mutation, 'UBERON_' || p_partkey AS structure FROM part""",
)
def entity_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, key = F.col("p_name"), F.col("p_partkey")
    return D.table(spark, sf_dir, "part").select(
        "p_partkey",
        T.entity_term("Gene", symbol=name).alias("gene"),
        T.entity_term("CellSet", name=name, uuid=F.lit("u")).alias("cell_set"),
        T.entity_term("Drug", id=F.when(key % 2 == 0, F.concat(F.lit("CHEMBL"), key)), label=T.field_name(name, {"a": "b"})).alias("drug"),
        T.entity_term("Publication", dataset=F.when(key % 3 == 0, "d"), doi=F.lit("doi")).alias("publication"),
        T.entity_term("ClinicalTrial", id=F.concat(F.lit("nct"), key)).alias("trial"),
        T.entity_term("Mutation", id=F.concat(F.lit("rs"), key)).alias("mutation"),
        T.entity_term("AnatomicalStructure", curie=F.concat(F.lit("UBERON:"), key)).alias("structure"),
    )


# ---- graph


@register("last_label_edges", "SELECT 'USER-USER' AS collection, user_id || '-EV:rel-' || (user_id + 1) AS key, 'USER/' || user_id AS src, 'USER/' || (user_id + 1) AS dst, arg_max(CASE WHEN event_type IN ('click', 'view') THEN 'REL' ELSE 'HAS_RELATION' END, event_id) AS label FROM events GROUP BY user_id")
def last_label_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two predicates with one CURIE, whose labels come from the URI and from the table of labels: of a user's tuples the
    last one's label stays. A predicate without a label makes no edge."""
    p = F.when(F.col("event_type").isin("click", "view"), "http://x.org/EV#rel").otherwise("http://x.org/EV_rel")
    rows = D.table(spark, sf_dir, "events").select(F.lit(0).alias("file_rank"), F.col("event_id").alias("seq"), D.uri("USER", text("user_id")).alias("s"), p.alias("p"), D.uri("USER", text(F.col("user_id") + 1)).alias("o"))
    none = rows.withColumn("p", F.lit("http://x.org/RO_9999999"))
    labels = spark.createDataFrame([("EV_rel", "has relation")], "term string, label string")
    return B.last_label_edges(rows.union(none), ("USER",), labels)


@register("edge_sources", f"WITH {LINKS} SELECT collection, key, split_part(src, '/', 1) AS source FROM edges WHERE collection IN ('NATION-REGION', 'CUST-NATION', 'SUPP-NATION')")
def edge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges with the source that follows from their subject; links under a predicate without a label make no edge."""
    links = D.links(spark, sf_dir).where(F.col("p").isin(P + "BFO_0000050", P + "RO_0001025"))
    unknown = links.withColumn("p", F.lit(P + "RO_9999999"))
    made = B.with_source(B.edges(links.unionByName(unknown), D.VALID, D.predicate_labels(spark)))
    return made.where("collection <> 'TURN-TURN'").select("collection", "key", "source")


@register("preferred_attributes", "SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE c_name END AS label FROM customer")
def preferred_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = lambda rows, c: rows.select(F.lit("CUST").alias("collection"), text("c_custkey").alias("key"), F.create_map(F.lit("label"), F.col(c)).alias("attrs"))
    customer = D.table(spark, sf_dir, "customer")
    found = sinks.prefer_full(doc(customer, "c_name"), doc(customer.where("c_custkey % 3 = 0"), "c_mktsegment"))
    return found.select("key", F.element_at("attrs", "label").alias("label"))


@register("vertex_insert_only", "SELECT CAST(coalesce(o.c_custkey, n.c_custkey) AS VARCHAR) AS key, CASE WHEN o.c_custkey IS NULL THEN n.c_mktsegment ELSE o.c_name END AS label FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0) o FULL JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) n ON o.c_custkey = n.c_custkey")
def vertex_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert that leaves known vertices as they are."""
    doc = lambda rows, c: rows.select(F.lit("CUST").alias("collection"), text("c_custkey").alias("key"), F.create_map(F.lit("label"), F.array(c)).alias("attrs"))
    customer = D.table(spark, sf_dir, "customer")
    made = B.upsert_vertices(doc(customer.where("c_custkey % 2 = 0"), "c_name"), doc(customer.where("c_custkey % 3 = 0"), "c_mktsegment"), update=False)
    return made.select("key", F.get(F.element_at("attrs", "label"), F.lit(0)).alias("label"))


@register(
    "subgraph_job",
    f"""{WALK}, {REACHED}, up AS (SELECT id FROM found WHERE id LIKE 'PART/%' UNION SELECT edges.dst FROM up JOIN edges ON edges.src = up.id AND edges.collection = 'PART-PART')
    SELECT 'vertex' AS kind, id FROM (SELECT id FROM found UNION SELECT id FROM up UNION SELECT 'NATION/' || key FROM verts WHERE collection = 'NATION')
    UNION ALL SELECT 'edge', collection || '/' || key FROM (SELECT collection, key FROM edges WHERE src IN (SELECT id FROM found) AND dst IN (SELECT id FROM found) UNION SELECT edges.collection, edges.key FROM edges JOIN up ON edges.src = up.id AND edges.collection = 'PART-PART')""",
)
def subgraph_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subgraph around suppliers, completed by its hierarchies, written and read again."""
    path = folder(spark)
    v, e = graph(spark, sf_dir)
    v = v.withColumn("attrs", F.create_map(F.lit("id"), F.array("key")))
    sinks.write_graph(*G.build_subgraph(v, e, "SUPP", RULES, DEPTH, **WALK_ARGS), path)
    v, e = files.graph_tables(spark, path)
    return v.select(F.lit("vertex").alias("kind"), F.concat_ws("/", "collection", "key").alias("id")).union(e.select(F.lit("edge"), F.concat_ws("/", "collection", "key")))


CHAIN = "up AS (SELECT p_partkey AS start, p_partkey AS k, 'PART/' || p_partkey AS chain FROM part UNION ALL SELECT start, k // 2, chain || ' PART/' || (k // 2) FROM up WHERE k > 0), chains AS (SELECT 'PART/' || start AS id, chain FROM up WHERE k = 0)"


@register("paths_with_chains", f"WITH RECURSIVE {LINKS}, {CHAIN} SELECT concat_ws(' ', a.dst, a.src, b.src) AS path, chain FROM edges a JOIN edges b ON b.dst = a.src AND b.collection = 'PART-SUPP' JOIN chains ON chains.id = b.src WHERE a.collection = 'SUPP-NATION'")
def paths_with_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = edges(spark, sf_dir, P + "RO_0001025", P + "RO_0003001", RDFS + "subClassOf").where("collection <> 'CUST-NATION'")
    found = G.paths_with_chains(e, "NATION", ("SUPP", "PART"), 2, "SUB_CLASS_OF")
    return found.select(F.array_join("vertices", " ").alias("path"), F.array_join("chain", " ").alias("chain"))


@register(
    "path_set",
    f"""WITH RECURSIVE {LINKS}, {CHAIN}, sn AS (SELECT src, dst, key FROM edges WHERE collection = 'SUPP-NATION'), ps AS (SELECT src, dst, key FROM edges WHERE collection = 'PART-SUPP')
    SELECT 'REGION NATION SUPP' AS pattern, concat_ws(' ', r.dst, r.src, sn.src) AS path, NULL::VARCHAR AS chain FROM edges r JOIN sn ON sn.dst = r.src WHERE r.collection = 'NATION-REGION'
    UNION ALL SELECT 'REGION NATION SUPP PART', concat_ws(' ', r.dst, r.src, sn.src, ps.src), chain FROM edges r JOIN sn ON sn.dst = r.src JOIN ps ON ps.dst = sn.src JOIN chains ON chains.id = ps.src WHERE r.collection = 'NATION-REGION'""",
)
def path_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several patterns that share prefixes, one with the chain above its last vertex."""
    e = edges(spark, sf_dir, P + "BFO_0000050", P + "RO_0001025", P + "RO_0003001", RDFS + "subClassOf")
    found = G.path_set(e, "REGION", [(("NATION", "SUPP"), None), (("NATION", "SUPP", "PART"), "SUB_CLASS_OF")])
    return found.select("pattern", F.array_join("vertices", " ").alias("path"), F.array_join("chain", " ").alias("chain"))


@register("path_set_members", f"WITH {LINKS}, p AS (SELECT r.dst AS a, r.src AS b, s.src AS c, 'NATION-REGION/' || r.key AS e, 'SUPP-NATION/' || s.key AS f FROM edges r JOIN edges s ON s.dst = r.src AND s.collection = 'SUPP-NATION' WHERE r.collection = 'NATION-REGION') SELECT 'vertex' AS kind, unnest([a, b, c]) AS id FROM p UNION SELECT 'edge', unnest([e, f]) FROM p")
def path_set_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = edges(spark, sf_dir, P + "BFO_0000050", P + "RO_0001025")
    v, among = G.members(G.path_set(e, "REGION", [(("NATION", "SUPP"), None)]))
    return v.select(F.lit("vertex").alias("kind"), "id").union(among.select(F.lit("edge"), "id"))


# ---- reports and search


@register("nested_difference", "SELECT n_nationkey AS key, '$.a.b' AS path, 'value' AS problem, n_name AS old, n_name || '!' AS new FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT n_nationkey, '$.list[]', 'length', '2', '1' FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT n_nationkey, '$.list[1]', 'missing', '2', NULL FROM nation WHERE n_nationkey % 3 = 0")
def nested_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = D.table(spark, sf_dir, "nation")
    doc = lambda name, items: nation.select(F.col("n_nationkey").alias("key"), F.parse_json(F.to_json(F.struct(F.struct(name.alias("b")).alias("a"), items.alias("list")))).alias("v"))
    k, two = F.col("n_nationkey"), F.array(F.lit(1), F.lit(2))
    new = doc(F.when(k % 5 == 0, F.concat("n_name", F.lit("!"))).otherwise(F.col("n_name")), F.when(k % 3 == 0, F.array(F.lit(1))).otherwise(two))
    return R.nested_difference(doc(F.col("n_name"), two), new, "key", "v")


@register("most_common", "SELECT p_type AS value, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, value LIMIT 10")
def most_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.most_common(D.table(spark, sf_dir, "part"), "p_type")


@register("statement_kinds", f"WITH {LITERALS} SELECT 'uri' AS s_kind, CASE attr WHEN 'label' THEN '{RDFS}label' ELSE '{D.SCHEMA}' || attr END AS p, 'literal' AS o_kind, count(*) AS n FROM literals WHERE value IS NOT NULL GROUP BY attr")
def statement_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.statement_kinds(D.literals(spark, sf_dir), lambda c: terms.node_kind(F.col(c)))


@register("search_view", "SELECT analyzer, count(*) AS n, CAST(sum(freq) AS BIGINT) AS freq FROM (SELECT 'text' AS analyzer, n_nationkey AS k, w AS token, count(*) AS freq FROM (SELECT n_nationkey, unnest(list_distinct([name[1:i] for i in range(3, 13) if i <= length(name)] || [name])) AS w FROM (SELECT n_nationkey, lower(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')) AS name FROM nation)) GROUP BY ALL) GROUP BY analyzer")
def search_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings over the shown fields of the shown collections; entries for edges are skipped."""
    read = lambda name, kind, key, label: D.table(spark, sf_dir, name).select(F.lit(kind).alias("collection"), text(key).alias("key"), F.lit("label").alias("field"), F.col(label).alias("text"))
    rows = read("nation", "NATION", "n_nationkey", "n_name").withColumn("text", F.regexp_replace("text", "[^A-Za-z0-9]", "")).union(read("customer", "CUST", "c_custkey", "c_name"))
    shown = D.table(spark, sf_dir, "region").select(F.element_at(F.array(F.lit("NATION"), F.lit("NATION-REGION")), (F.col("r_regionkey") % 2 + 1).cast("int")).alias("collection"), F.lit("label").alias("field"))
    return X.view(rows, shown, ("NATION", "REGION")).where("analyzer = 'text'").groupBy("analyzer").agg(F.count("*").alias("n"), F.sum("freq").alias("freq"))


@register("text_tokens", "WITH w AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS token, generate_subscripts(string_split(p_name, ' '), 1) - 1 AS place, len(string_split(p_name, ' ')) AS norm FROM part) SELECT CAST(p_partkey AS VARCHAR) AS key, token, count(*) AS freq, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS positions, CAST(max(norm) AS INTEGER) AS norm FROM w GROUP BY p_partkey, token")
def text_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.table(spark, sf_dir, "part").select(F.lit("PART").alias("collection"), text("p_partkey").alias("key"), F.lit("label").alias("field"), F.col("p_name").alias("text"))
    return X.text_tokens(rows).select("key", "token", "freq", F.array_join(F.transform("positions", text), ",").alias("positions"), "norm")


# ---- schema tables


def schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and regions in the place of a schema table."""
    both = D.table(spark, sf_dir, "nation").join(D.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    relation = F.when(F.col("n_nationkey") % 2 == 0, "part_of").otherwise("??? Need looser relationship to express that the two are merely associated")
    left = F.when(F.col("n_nationkey") == 3, "Cellular_component").otherwise(F.concat("n_name", F.lit(" (subtype/child)")))
    return S.schema_rows(both.select(left.alias("subject"), relation.alias("predicate"), F.concat("r_name", F.lit("_class")).alias("object"), F.lit("Class-Individual").alias("connections")))


def schema_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = D.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("row_no"), F.when(F.col("r_regionkey") == 0, "Organism/Species").otherwise(F.col("r_name")).alias("name"), F.concat(F.lit("R:"), "r_regionkey").alias("curie"))
    return S.schema_terms(region)


@register("schema_curies", "SELECT n_name AS subject, CASE WHEN n_nationkey % 2 = 0 THEN 'part_of' ELSE 'ASSOCIATED_WITH' END AS predicate, r_name || '_Individual' AS object_type, 'NA' AS subject_curie, CASE WHEN r_regionkey = 0 THEN 'NA' ELSE 'R:' || r_regionkey END AS object_curie FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 3")
def schema_curies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_curies(schema(spark, sf_dir), schema_names(spark, sf_dir)).select("subject", "predicate", "object_type", "subject_curie", "object_curie")


@register("schema_missing", "SELECT 'subject' AS role, n_name AS name FROM nation WHERE n_nationkey <> 3 UNION ALL SELECT 'object', r_name FROM region WHERE r_regionkey = 0 UNION ALL SELECT 'predicate', unnest(['part_of', 'ASSOCIATED_WITH'])")
def schema_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.missing_names(schema(spark, sf_dir), schema_names(spark, sf_dir))


@register("schema_classes", "SELECT n_name AS name, true AS as_subject, false AS as_object FROM nation WHERE n_nationkey <> 3 UNION ALL SELECT r_name, false, true FROM region")
def schema_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.unique_classes(schema(spark, sf_dir))


@register("schema_subset", "WITH s AS (SELECT n_name AS s, CASE WHEN n_nationkey % 2 = 0 THEN 'part_of' ELSE 'ASSOCIATED_WITH' END AS p, r_name AS o FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 3 AND r_name = 'ASIA') SELECT 'subjects' AS sheet, s AS a, NULL::VARCHAR AS b, NULL::VARCHAR AS c FROM s UNION SELECT 'objects', o, NULL, NULL FROM s UNION SELECT 'vertices', unnest([s, o]), NULL, NULL FROM s UNION SELECT 'names', s, p, o FROM s UNION SELECT 'curies', 'NA', 'NA', 'R:2' FROM s")
def schema_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.schema_subset(S.with_curies(schema(spark, sf_dir), schema_names(spark, sf_dir)), objects=("ASIA",))


@register("schema_tuples", f"SELECT '{P}N_' || n_nationkey AS s, '{P}RO_1' AS p, '{P}' || CASE WHEN n_nationkey % 2 = 0 THEN 'MONDO_0000001' ELSE 'EFO_0002772' END AS o FROM nation")
def schema_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that name several terms take the one that stands for them."""
    other = F.when(F.col("n_nationkey") % 2 == 0, "MONDO:0000001 or MONDO:0021178").otherwise("EFO:0002772 or EFO:0010183")
    return S.schema_tuples(D.table(spark, sf_dir, "nation").select(F.concat(F.lit("N:"), "n_nationkey").alias("subject"), F.lit("RO:1").alias("predicate"), other.alias("object")))


# ---- raw records


@register("dataset_fields", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment || ' (199' || c_nationkey % 10 || ') J' AS \"Citation\", c_mktsegment || ', A, , B' AS \"Author_list\", c_name AS \"Title\", 'doi/' || c_custkey AS \"Link_to_publication\", CAST(c_nationkey AS BIGINT) AS \"Number_of_cells\", 'mouse, ' || c_name AS \"Organism\" FROM customer")
def dataset_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    author = lambda a, b: F.struct(a.alias("family"), b.alias("given"))
    meta = F.struct(F.array(author(F.col("c_mktsegment"), F.lit("A")), author(F.lit(None).cast("string"), F.lit("B"))).alias("authors"), F.concat(F.lit("199"), F.col("c_nationkey") % 10).alias("published_year"), F.lit("J").alias("journal"))
    said = F.concat(F.lit("Publication: doi/"), "c_custkey", F.lit(" Dataset Version: v Collection: c"))
    organism = F.array(F.struct(F.lit("mouse").alias("label")), F.struct(F.col("c_name").alias("label")))
    dataset = F.parse_json(F.to_json(F.struct(said.alias("citation"), F.col("c_nationkey").alias("cell_count"), organism.alias("organism"))))
    collection = F.parse_json(F.to_json(F.struct(F.col("c_name").alias("name"), meta.alias("publisher_metadata"))))
    raw = D.table(spark, sf_dir, "customer").select(text("c_custkey").alias("id"), dataset.alias("dataset"), collection.alias("collection"))
    return V.dataset_fields(raw).select("id", "Citation", "Author_list", "Title", "Link_to_publication", "Number_of_cells", "Organism")


@register("protein_fields", "SELECT s_suppkey AS id, s_name AS \"Protein_name\", CAST(s_nationkey AS BIGINT) AS \"Number_of_amino_acids\", 'last' AS \"Function\", CAST(s_nationkey + 0.5 AS DOUBLE) AS \"Annotation_score\" FROM supplier")
def protein_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.struct(F.struct(F.struct(F.col("s_name").alias("value")).alias("fullName")).alias("recommendedName"))
    comment = lambda kind, value: F.struct(F.lit(kind).alias("commentType"), F.array(F.struct(F.lit(value).alias("value"))).alias("texts"))
    body = F.struct(named.getField("recommendedName").alias("r"), F.array(comment("FUNCTION", "first"), comment("OTHER", "x"), comment("FUNCTION", "last")).alias("comments"), F.struct(F.col("s_nationkey").alias("length")).alias("sequence"), (F.col("s_nationkey") + 0.5).alias("annotationScore"))
    payload = F.parse_json(F.replace(F.to_json(F.struct(F.struct(body.getField("r").alias("recommendedName")).alias("proteinDescription"), body.getField("comments").alias("comments"), body.getField("sequence").alias("sequence"), body.getField("annotationScore").alias("annotationScore"))), F.lit("\u0000"), F.lit("")))
    raw = D.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), payload.alias("payload"))
    return V.protein_fields(raw).select("id", "Protein_name", "Number_of_amino_acids", "Function", "Annotation_score")


@register("target_fields", "SELECT n_nationkey AS id, n_name AS symbol, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS diseases FROM nation")
def target_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resources stand under ``rows`` or directly."""
    head = F.concat(F.lit('{"target": {"id": "T", "symbol": "'), "n_name", F.lit('"}, "diseases": '))
    rows = F.when(F.col("n_nationkey") % 2 == 0, '{"rows": [{"score": 1}, {"score": 2}]}').otherwise('[{"score": 1}]')
    raw = D.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.parse_json(F.concat(head, rows, F.lit("}"))).alias("payload"))
    size = F.size(F.try_variant_get("diseases", "$", "array<variant>"))
    return V.target_fields(raw).select("id", V.at(F.col("target"), "$.symbol").alias("symbol"), size.alias("diseases"))


@register("gene_fields", "SELECT p_partkey AS id, p_name AS \"Official_symbol\", p_brand AS \"Summary\", 'P' || p_partkey AS \"UniProt_name\" FROM part")
def gene_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    xml = F.concat(F.lit("<E><Gene-ref_formal-name><Gene-nomenclature><Gene-nomenclature_symbol>"), "p_name", F.lit("</Gene-nomenclature_symbol></Gene-nomenclature></Gene-ref_formal-name><Entrezgene_summary>"), "p_brand", F.lit("</Entrezgene_summary><Other-source_url>https://www.uniprot.org/uniprot/P"), "p_partkey", F.lit(".txt</Other-source_url></E>"))
    return V.gene_fields(D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), xml.alias("xml"))).select("id", "Official_symbol", "Summary", "UniProt_name")


@register("columnar_rows", "SELECT n_nationkey AS id, 'a' AS field, n_name AS value FROM nation UNION ALL SELECT n_nationkey, 'b', 'first' FROM nation")
def columnar_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named row of each column, or else the column's first one."""
    payload = F.parse_json(F.concat(F.lit('{"a": {"1": "x", "0": "'), "n_name", F.lit('"}, "b": {"7": "first", "8": "second"}}')))
    return V.columnar_row(D.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), payload.alias("payload")))


@register("text_functions", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS DOUBLE) END AS number, CASE WHEN p_partkey % 3 = 0 THEN p_brand || ' et al. (2020) J' ELSE p_brand || ' (2020) J' END AS citation, 'P' || p_partkey AS accession, 'GO' AS source FROM part")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    authors = F.when(key % 3 == 0, F.array(F.col("p_brand"), F.lit("x"))).otherwise(F.array("p_brand"))
    return D.table(spark, sf_dir, "part").select(
        "p_partkey",
        terms.as_number(F.when(key % 2 == 0, text(key)).otherwise("NaN")).alias("number"),
        terms.citation(authors, F.lit(2020), F.lit("J")).alias("citation"),
        terms.last_accession(F.array(F.concat(F.lit("https://www.uniprot.org/P"), key, F.lit(".txt")), F.lit("https://other"))).alias("accession"),
        terms.edge_source(F.lit("go-plus")).alias("source"),
    )


# ---- older rules


#: An annotation of each kind for every eighth customer, written as files of records.
ANNOTATED = f"""a AS (
  SELECT c_custkey AS k, ['Anatomical_structure', 'Assay', 'Biomarker_combination', 'Cell_set', 'Cell_set_dataset', 'Cell_type', 'Gene', 'Publication'][c_custkey % 8 + 1] AS kind, c_name AS name, c_nationkey AS n, 'u' || c_custkey || '-x' AS owner FROM customer),
t AS (SELECT k, kind, name, n, '{P}CS_' || replace(name, '_', '-') || '-u' || k AS s, CASE WHEN n < 20 THEN '{P}MONDO_' || n END AS disease, '{P}' || CASE kind
  WHEN 'Anatomical_structure' THEN 'UBERON_' || k WHEN 'Assay' THEN 'EFO_' || k WHEN 'Biomarker_combination' THEN 'BMC_' || name || '-u' || k WHEN 'Cell_set' THEN 'CS_' || name || '-u' || k
  WHEN 'Cell_set_dataset' THEN 'CSD_' || k WHEN 'Cell_type' THEN 'CL_' || k WHEN 'Gene' THEN CASE WHEN n % 2 = 0 THEN 'GS_G' || k END WHEN 'Publication' THEN 'PUB_doi.org/10.1126/science.adf6812' END AS o FROM a)"""


def annotation_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder of JSON records: customers as cell sets, each with a disease and with one of the other kinds."""
    key, kinds = F.col("c_custkey"), ("Anatomical_structure", "Assay", "Biomarker_combination", "Cell_set", "Cell_set_dataset", "Cell_type", "Gene", "Publication")
    marks = ("UBERON:", "EFO:", "", "", "NLP_dataset_", "CL:<skos:related>", "", "")
    kind = F.get(F.array(*map(F.lit, kinds)), key % 8)
    ident = F.when(kind == "Publication", "37824655").otherwise(F.concat(F.get(F.array(*map(F.lit, marks)), key % 8), text(key)))
    name = F.when(kind == "Gene", F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("G"), text(key))).otherwise("lower")).otherwise(F.col("c_name"))
    cell_set = [text(key).alias("id"), F.lit("s").alias("subject"), F.lit("Cell_set").alias("subject_type"), F.col("c_name").alias("subject_name"), F.concat(F.lit("u"), key, F.lit("-x")).alias("subject_identifier")]
    customer = D.table(spark, sf_dir, "customer")
    ends = lambda relation, kind, name, ident: customer.select(*cell_set, F.lit(relation).alias("relation"), F.lit("o").alias("object"), kind.alias("object_type"), name.alias("object_name"), ident.alias("object_identifier"))
    path = folder(spark)
    rows = ends("has", F.lit("Disease"), F.lit("d"), F.concat(F.lit("MESH:"), "c_nationkey")).unionByName(ends("with", kind, name, ident)).unionByName(ends("unknown", kind, name, ident))
    rows.write.json(path)
    return path


@register(
    "annotation_tuples",
    f"""WITH {ANNOTATED}, r AS (SELECT s, '{P}RO_1' AS p, disease AS o, name, NULL AS label FROM t WHERE disease IS NOT NULL UNION ALL SELECT s, '{P}RO_2', o, name, CASE WHEN kind = 'Cell_set' THEN name END FROM t WHERE o IS NOT NULL)
    SELECT 3 AS arity, s, p, o, NULL AS value FROM r UNION ALL SELECT 5, s, p, o, 'Manual Annotation' FROM r UNION ALL SELECT 3, s, '{RDF}Label', name, NULL FROM r UNION ALL SELECT 3, o, '{RDF}Label', label, NULL FROM r WHERE label IS NOT NULL""",
)
def annotation_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all kinds of node are scanned and written as tuples; unknown relations, genes not in capitals and diseases without a term make none."""
    mesh = D.table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.concat(F.lit("MESH:"), "n_nationkey").alias("mesh"), F.concat(F.lit("MONDO:"), "n_nationkey").alias("mondo"))
    known = spark.createDataFrame([("has", "RO_1"), ("with", "RO_2")], "relation string, predicate string")
    return O.annotation_tuples(files.annotation_records(spark, annotation_files(spark, sf_dir), lines=True), mesh, known).select("arity", "s", "p", "o", "value")


@register(
    "annotation_components",
    f"""WITH {ANNOTATED}, e AS (SELECT 'has' AS relation, 'Disease' AS ot, 'd' AS oname, 'MESH:' || n AS oid, name, k FROM a
      UNION ALL SELECT unnest(['with', 'unknown']), kind, CASE WHEN kind = 'Gene' THEN CASE WHEN n % 2 = 0 THEN 'G' || k ELSE 'lower' END ELSE name END,
        CASE kind WHEN 'Publication' THEN '37824655' WHEN 'Anatomical_structure' THEN 'UBERON:' || k WHEN 'Assay' THEN 'EFO:' || k WHEN 'Cell_set_dataset' THEN 'NLP_dataset_' || k WHEN 'Cell_type' THEN 'CL:<skos:related>' || k ELSE '' || k END, name, k FROM a),
    parts AS (SELECT 'subject' AS role, 'Cell_set' AS type, name, 'u' || k || '-x' AS ident FROM e UNION ALL SELECT 'object', ot, oname, oid FROM e UNION ALL SELECT 'relation', relation, NULL, NULL FROM e)
    SELECT role, type, count(*) AS n, count(DISTINCT name) AS names, count(DISTINCT ident) AS identifiers FROM parts GROUP BY role, type""",
)
def annotation_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What annotations are made of: types on either side with their names and identifiers, and relations."""
    found = R.components_of_triples(files.annotation_records(spark, annotation_files(spark, sf_dir), lines=True))
    return found.select("role", "type", "n", *[F.size(c).cast("long").alias(c) for c in ("names", "identifiers")])


@register("mapping_relations", f"WITH m AS (SELECT '{P}CL_' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS cl, '{P}GS_' || c_mktsegment AS gs, c_nationkey FROM customer) SELECT cl AS s, '{P}BFO_0000050' AS p, '{P}UBERON_' || c_nationkey AS o FROM m UNION ALL SELECT gs, '{P}BFO_0000050', cl FROM m UNION ALL SELECT cl, '{P}RO_0002294', gs FROM m UNION ALL SELECT '{P}GS_B', '{P}BFO_0000050', cl FROM m UNION ALL SELECT cl, '{P}RO_0002294', '{P}GS_B' FROM m")
def mapping_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cluster"), F.concat(F.lit("CL:"), F.lpad(text("c_custkey"), 7, "0")).alias("cell_type"), F.concat(F.lit("UBERON:"), "c_nationkey").alias("uberon"), F.array("c_mktsegment").alias("markers"), F.array(F.lit("B"), F.col("c_mktsegment")).alias("binary_genes"))
    return O.mapping_relations(rows).where("arity = 3").select("s", "p", "o")


@register("instance_typing", f"SELECT '{P}BMC_' || p_partkey AS s, '{RDF}type' AS p, '{P}SO_0001260' AS o FROM part UNION ALL SELECT '{P}BMC_' || p_partkey, '{RDF}Markers', p_name FROM part UNION ALL SELECT '{P}BMC_' || p_partkey, '{RDF}Binary_genes', p_brand FROM part")
def instance_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cluster"), text("p_partkey").alias("uuid"), F.split("p_name", " ").alias("markers"), F.array("p_brand").alias("binary_genes"))
    return O.instance_typing(rows).select("s", "p", "o")


@register("drug_attributes", f"SELECT '{P}CHEMBL_' || p_partkey AS s, '{RDF}Synonyms' AS p, replace(p_name, ' ', ', ') AS o FROM part UNION ALL SELECT '{P}CHEMBL_' || p_partkey, '{RDF}Target', p_brand FROM part UNION ALL SELECT '{P}CHEMBL_' || p_partkey, '{RDF}Link_to_PubChem', 'pubchem.ncbi.nlm.nih.gov/compound/' || p_size FROM part WHERE p_size > 9 UNION ALL SELECT '{P}CHEMBL_' || p_partkey, '{RDF}Indications', replace(p_type, ' ', ', ') FROM part WHERE p_partkey % 2 = 0")
def drug_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    indications = F.when(F.col("p_partkey") % 2 == 0, F.split("p_type", " ")).otherwise(F.array().cast("array<string>"))
    rows = D.table(spark, sf_dir, "part").select(text("p_partkey").alias("id"), indications.alias("indications"), F.col("p_brand").alias("target"), F.split("p_name", " ").alias("synonyms"), F.when(F.col("p_size") > 9, text("p_size")).alias("pubchem"))
    return O.drug_attributes(rows).select("s", "p", "o")


@register("field_dump", f"SELECT '{P}GS_' || s_suppkey AS s, '{RDF}s_name' AS p, s_name AS o FROM supplier UNION ALL SELECT '{P}GS_' || s_suppkey, '{RDF}s_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier")
def field_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.table(spark, sf_dir, "supplier").withColumn("id", text("s_suppkey"))
    return O.field_dump(rows, "GS", "id", ("s_name", "s_nationkey")).select("s", "p", "o")


@register("summary_mode", "SELECT p_partkey, string_split(p_name, ' ')[1] AS first, least(len(string_split(p_name, ' ')), 1) AS n FROM part WHERE p_size > 10 ORDER BY p_partkey LIMIT 1")
def summary_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = O.summarised(D.table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " ")), "p_partkey", F.col("p_size") > 10, ("words",), 1)
    return found.select("p_partkey", F.get("words", F.lit(0)).alias("first"), F.size("words").cast("long").alias("n"))


@register("entity_records", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'CL:0000001' END AS cell_type, CASE WHEN c_custkey % 3 = 0 THEN 'UBERON:' || c_nationkey END AS structure, 'CS_' || c_name || '-u' AS cell_set, CASE WHEN c_custkey % 5 = 0 THEN c_custkey END AS pmid FROM customer")
def entity_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = D.table(spark, sf_dir, "customer").select(
        F.when(key % 2 == 0, "CL:0000001").otherwise("x").alias("cell_type"), F.lit("n").alias("cell_type_name"), F.when(key % 3 == 0, F.concat(F.lit(f"{P}UBERON_"), "c_nationkey")).otherwise(f"{P}FMA_1").alias("uberon_purl"),
        F.col("c_name").alias("cluster"), F.lit("u").alias("uuid"), text(key).alias("dataset"), F.when(key % 5 == 0, text(key)).otherwise("1.5").alias("pmid"), F.lit(None).cast("string").alias("gene"),
    )
    made = O.entity_records(rows)
    return made.select(F.substr(F.col("dataset.id"), F.lit(5)).cast("long").alias("c_custkey"), F.col("cell_type.id").alias("cell_type"), F.col("anatomical_structure.id").alias("structure"), F.col("cell_set.id").alias("cell_set"), F.col("publication.pmid").alias("pmid"))


@register(
    "tuples_by_pmid",
    f"""WITH m AS (SELECT '{P}CL_' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS cl, '{P}CSD_' || c_nationkey AS d, '{P}PUB_' || c_custkey AS pub, unnest(['{P}GS_' || c_mktsegment, '{P}GS_B']) AS gene FROM customer),
    r AS (SELECT DISTINCT d AS s, '{T.DC}source' AS p, pub AS o FROM m UNION ALL SELECT DISTINCT cl, '{P}BFO_0000050', '{P}UBERON_1' FROM m
      UNION ALL SELECT gene, '{P}BFO_0000050', cl FROM m UNION ALL SELECT cl, '{P}RO_0002294', gene FROM m UNION ALL SELECT cl, '{P}RO_0002292', gene FROM m)
    SELECT 3 AS arity, s, p, o, NULL AS value FROM r UNION ALL SELECT 5, s, p, o, 'Manual Mapping' FROM r""",
)
def tuples_by_pmid(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = D.table(spark, sf_dir, "customer")
    mappings = c.select(text("c_nationkey").alias("dataset"), F.col("c_custkey").alias("pmid"), F.col("c_name").alias("cluster"), F.concat(F.lit("CL:"), F.lpad(text("c_custkey"), 7, "0")).alias("cell_type"), F.lit("UBERON:1").alias("uberon"))
    clusters = c.select(text("c_nationkey").alias("dataset"), F.col("c_name").alias("cluster"), F.lit("u").alias("uuid"), F.array("c_mktsegment").alias("markers"), F.array(F.lit("B"), F.col("c_mktsegment")).alias("binary_genes"))
    return O.dataset_tuples_by_pmid(mappings, clusters).select("arity", "s", "p", "o", "value")


@register("drug_names", "SELECT DISTINCT p_brand AS name FROM part WHERE p_size > 20")
def drug_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.table(spark, sf_dir, "part").select(F.array(F.struct(F.col("p_brand").alias("name"), (F.col("p_size") <= 20).alias("withdrawn"))).alias("drugs"))
    return O.drug_names(rows)


@register("filled_nodes", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_mktsegment END AS filled, c_custkey % 3 = 1 AS whole, 'v' || c_custkey AS value FROM customer")
def filled_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two nodes the one that isn't blank, triples without blank nodes, and the first concept of a name."""
    key = F.col("c_custkey")
    concepts = F.array(F.struct(F.lit("x").alias("propName"), F.lit("y").alias("propValue")), F.struct(F.lit("N").alias("propName"), F.concat(F.lit("v"), key).alias("propValue")), F.struct(F.lit("N").alias("propName"), F.lit("later").alias("propValue")))
    rows = D.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", F.when(key % 3 == 0, "_:b").otherwise("s").alias("s"), F.when(key % 3 == 2, "_:b").otherwise("o").alias("o"), concepts.alias("concepts"))
    whole = O.filled_triples(rows).select("c_custkey", F.lit(True).alias("whole"))
    filled = O.filled_node(F.col("c_mktsegment"), F.col("c_name"), F.col("s").startswith("_:"))
    return rows.join(whole, "c_custkey", "left").select("c_custkey", filled.alias("filled"), F.coalesce("whole", F.lit(False)).alias("whole"), O.concept_value(F.col("concepts"), "N").alias("value"))


@register("cell_terms", "SELECT DISTINCT 'CL_' || c_nationkey AS term FROM customer WHERE c_custkey % 2 = 0")
def cell_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    purl = F.concat(F.lit(P), F.when(F.col("c_custkey") % 2 == 0, "CL_").otherwise("GO_"), "c_nationkey")
    return O.cell_terms(D.table(spark, sf_dir, "customer").select(purl.alias("cell_ontology_id")))
