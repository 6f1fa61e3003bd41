"""Registered queries of older rules: the property graph of tuples, strict checks, flags, imports, anatomy files, payloads; and of
attributes that writers take from scores and warnings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators import datasets as S
from weftgraph.operators import graph_build as B
from weftgraph.operators import lookups as L
from weftgraph.operators import sinks
from weftgraph.operators import transforms as V
from weftgraph.operators import writers as T
from weftgraph.plans.more_queries import folder, owl_lines, text
from weftgraph.plans.registry import register
from weftgraph.sources import derived as D
from weftgraph.sources import files

P, RDF = T.PURL, T.RDF


@register(
    "legacy_graph",
    """WITH e AS (SELECT user_id AS u, event_id AS i, event_type AS t, printf('%.2f', value) AS v FROM events)
    SELECT 'vertex' AS kind, 'USER_' || u AS id, t AS label, string_agg(v, ',' ORDER BY i) AS vals FROM (SELECT u, t, v, min(i) AS i FROM e GROUP BY u, t, v) GROUP BY u, t
    UNION ALL SELECT 'edge', 'USER/' || u || ' USER/' || (u + 1), l, string_agg(v, ',' ORDER BY i) FROM (SELECT u, v, min(i) AS i FROM e GROUP BY u, v) JOIN (SELECT u, arg_min(t, i) AS l FROM e GROUP BY u) USING (u) GROUP BY u, l
    UNION ALL SELECT 'vertex', 'USER_' || (max(u) + 1), NULL, NULL FROM e WHERE (SELECT max(u) + 1 FROM e) NOT IN (SELECT u FROM e)""",
)
def legacy_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' events as literals, as links to the next user and as attributes of these: lists in order, the first label of an edge."""
    e = D.table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("u"), F.concat(F.lit("http://x.org/p#"), "event_type").alias("p"), F.format_string("%.2f", "value").alias("v"))
    s, o = D.uri("USER", text("u")), D.uri("USER", text(F.col("u") + 1))
    triples = e.select("seq", s.alias("s"), "p", F.col("v").alias("o")).unionByName(e.select("seq", s.alias("s"), "p", o.alias("o")))
    nodes, edges = B.legacy_graph(triples, e.select("seq", s.alias("s"), o.alias("o"), F.lit("value").alias("attr"), F.col("v").alias("value")), ("USER",))
    shown = lambda rows, kind, name, label: rows.select(F.lit(kind).alias("kind"), name.alias("id"), F.explode_outer("attrs").alias("attr", "values"), *label).select("kind", "id", (F.col("label") if label else F.col("attr")).alias("label"), F.array_join("values", ",").alias("vals"))
    return shown(nodes, "vertex", F.col("term"), ()).union(shown(edges, "edge", F.concat_ws(" ", "src", "dst"), (F.col("label"),)))


@register("rejected_tuples", f"SELECT o_orderkey AS seq, CASE o_orderkey % 5 WHEN 0 THEN 'subject' WHEN 1 THEN 'predicate' WHEN 2 THEN 'value' END AS problem FROM orders")
def rejected_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed tuples, and the others with what is wrong with them."""
    kind = F.col("o_orderkey") % 5
    uri = lambda good: F.when(good, F.lit(P + "A_1")).otherwise("text")
    rows = D.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), F.when(kind == 3, 3).when(kind == 4, 4).otherwise(5).alias("arity"), uri(~kind.isin(0, 4)).alias("s"), uri(kind != 1).alias("p"), F.lit(P + "B_2").alias("o"),
        F.lit("a").alias("attr"), uri(kind == 2).alias("value"),
    )
    good, bad = B.checked(rows)
    return good.select("seq", F.lit(None).cast("string").alias("problem")).unionByName(bad.select("seq", "problem"))


@register("flagged_terms", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'MONDO_' ELSE 'CL_' END || p_size AS term, p_size % 3 = 0 AS deprecated FROM part WHERE p_partkey % 2 = 1 OR p_size % 3 > 0")
def flagged_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deprecated terms: those of one ontology are dropped, others flagged."""
    part = D.table(spark, sf_dir, "part")
    name = lambda prefix: F.concat(F.lit(prefix), "p_size")
    gone = part.where("p_size % 3 = 0").select(F.explode(F.array(name("MONDO_"), name("CL_"))).alias("term"))
    return L.flagged(part.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, name("MONDO_")).otherwise(name("CL_")).alias("term")), "term", gone)


@register("edge_insert_only", "SELECT coalesce(o.c_custkey, n.c_custkey) AS k, CASE WHEN o.c_custkey IS NULL THEN 'NEW' ELSE 'OLD' END AS label FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0) o FULL JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0 AND c_nationkey > 4) n ON o.c_custkey = n.c_custkey")
def edge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New edges are added if both of their ends are there, known ones stay as they are."""
    c, key = D.table(spark, sf_dir, "customer"), text("c_custkey")
    made = lambda rows, label: rows.select(F.lit("CUST-NATION").alias("collection"), key.alias("key"), F.concat(F.lit("CUST/"), key).alias("src"), F.concat(F.lit("NATION/"), "c_nationkey").alias("dst"), F.array(F.lit(label)).alias("labels"))
    ends = c.select(F.lit("CUST").alias("collection"), key.alias("key")).union(c.where("c_nationkey > 4").select(F.lit("NATION"), text("c_nationkey")))
    found = B.upsert_edges(made(c.where("c_custkey % 2 = 0"), "OLD"), made(c.where("c_custkey % 3 = 0"), "NEW"), ends, update=False)
    return found.select(F.col("key").cast("long").alias("k"), F.get("labels", F.lit(0)).alias("label"))


@register(
    "import_report",
    """WITH c AS (SELECT n_regionkey || '.owl' AS file, 'N' || (n_nationkey % 4) AS namespace, count(*) AS classes FROM nation GROUP BY ALL), i AS (SELECT DISTINCT n_regionkey || '.owl' AS file, unnest(['N1', 'RO']) AS namespace FROM nation)
    SELECT file, namespace, coalesce(namespace = 'N1' AND classes > 0, false) AS is_root, i.namespace IS NOT NULL AS imported, coalesce(classes, 0) AS classes FROM c FULL JOIN i USING (file, namespace)""",
)
def import_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each ontology imports beside the namespaces of its own classes."""
    nation, name = D.table(spark, sf_dir, "nation"), F.concat("n_regionkey", F.lit(".owl"))
    classes = nation.select(name.alias("file"), F.col("n_nationkey").alias("position"), F.concat(F.lit(f"{P}N"), F.col("n_nationkey") % 4, F.lit("_"), "n_nationkey").alias("about"))
    headers = nation.select(name.alias("file"), F.lit(f"{P}N1_0").alias("root"), F.array(F.lit("N1"), F.lit("RO")).alias("imports")).distinct()
    return files.import_report(headers, classes, files.root_namespaces(classes, headers))


@register("imported_namespaces", "SELECT DISTINCT upper(replace(r_name, ' ', '-')) AS namespace FROM region UNION SELECT 'N' || n_nationkey FROM nation")
def imported_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imports of an ontology's header: the last part of each, without its ending, in capitals."""
    lines = owl_lines(spark, sf_dir)
    named = D.table(spark, sf_dir, "region").select(F.concat(F.lower(F.replace("r_name", F.lit(" "), F.lit("-"))), F.lit(".owl")).alias("name")).union(D.table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey")))
    imports = named.agg(F.array_join(F.collect_list(F.concat(F.lit('<owl:imports rdf:resource="http://x.org/a/'), "name", F.lit('"/>'))), "").alias("imports"))  # of two small tables
    path = folder(spark)
    marked = lines.join(F.broadcast(imports), F.col("value").contains("</owl:Ontology>"), "left")
    sinks.write_lines(marked.select(F.replace("value", F.lit("</owl:Ontology>"), F.concat(F.coalesce("imports", F.lit("")), F.lit("</owl:Ontology>"))).alias("value")).coalesce(1), "value", path)
    return files.ontology_headers(spark, path).select(F.explode("imports").alias("namespace"))


@register("terms_by_label", "SELECT s_name AS label, 'SUPP_' || s_suppkey AS term FROM supplier")
def terms_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inverse of the labels of an ontology's terms."""
    path = folder(spark)
    sinks.write_lines(owl_lines(spark, sf_dir).coalesce(1), "value", path)
    return files.labels_to_terms(files.term_labels(files.ontology_terms(spark, path)))


@register("listed_files", "SELECT n_regionkey AS region, count(*) AS bytes FROM nation GROUP BY n_regionkey")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose names match a pattern as a whole, one for each region here; marks of success and the like don't match."""
    path = folder(spark)
    D.table(spark, sf_dir, "nation").repartition(1).select("n_regionkey", F.lit("").alias("value")).write.partitionBy("n_regionkey").text(path)
    found = files.files_matching(spark, f"{path}/n_regionkey=*", r"part-.*\.txt").unionByName(files.files_matching(spark, f"{path}/n_regionkey=*", r"part"))
    lines = spark.read.text(f"{path}/n_regionkey=*").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("bytes"))
    return found.join(lines, "path").select(F.regexp_extract("path", r"n_regionkey=(\d+)", 1).cast("int").alias("region"), "bytes")


@register(
    "anatomy_files",
    f"""WITH s AS (SELECT '{P}UBERON_' || n_nationkey AS s, n_name, '{P}UBERON_' || (100 + n_regionkey) AS o FROM nation), c AS (SELECT '{P}CL_' || c_custkey AS s, '{P}UBERON_' || c_nationkey AS o FROM customer WHERE c_custkey % 2 = 0)
    SELECT s, '{P}BFO_0000050' AS p, o FROM s UNION ALL SELECT s, '{RDF}Label', n_name FROM s UNION ALL SELECT s, '{P}BFO_0000050', o FROM c""",
)
def anatomy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each region with its structures and cell types, scanned and written as tuples; cell types must be known."""
    n, c = D.table(spark, sf_dir, "nation"), D.table(spark, sf_dir, "customer")
    structure = F.struct(F.concat(F.lit("UBERON:"), "n_nationkey").alias("id"), F.col("n_name").alias("ccf_pref_label"), F.array(F.concat(F.lit("UBERON:"), F.col("n_regionkey") + 100)).alias("ccf_part_of"))
    cell = F.struct(F.concat(F.lit("CL:"), "c_custkey").alias("id"), F.array(F.concat(F.lit("UBERON:"), "c_nationkey")).alias("ccf_located_in"))
    cells = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").agg(F.collect_list(cell).alias("cell_types"))
    rows = n.groupBy("n_regionkey").agg(F.collect_list(structure).alias("anatomical_structures")).join(cells, "n_regionkey", "left")
    path = folder(spark)
    rows.select("n_regionkey", F.to_json(F.struct(F.struct("anatomical_structures", "cell_types").alias("data"))).alias("value")).write.partitionBy("n_regionkey").text(path)
    structures, types = files.anatomical_graph(spark, f"{path}/n_regionkey=*")
    known = c.where("c_custkey % 2 = 0").select(F.concat(F.lit("CL:"), "c_custkey").alias("id"))
    made = T.part_of_tuples(structures).unionByName(T.cell_type_part_of_tuples(types, known))
    return made.where("arity = 3").select("s", "p", "o")


@register("decoded_payloads", "SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS text FROM customer")
def decoded_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads in base64 of gzip data; what isn't gives null. The data is a stored gzip block, made by expressions."""
    name = F.col("c_name").cast("binary")
    size = F.octet_length("c_name")
    little = lambda x, n: F.concat(*[F.unhex(F.lpad(F.hex(F.shiftrightunsigned(x.cast("long"), 8 * i).bitwiseAND(F.lit(255))), 2, "0")) for i in range(n)])
    packed = F.concat(F.unhex(F.lit("1f8b08000000000000ff01")), little(size, 2), little(F.lit(65535) - size, 2), name, little(F.crc32(name), 4), little(size, 4))
    payload = F.when(F.col("c_custkey") % 3 == 0, F.when(F.col("c_custkey") % 2 == 0, "no base64!").otherwise("AAAA")).otherwise(F.base64(packed))
    return D.table(spark, sf_dir, "customer").select("c_custkey", V.decoded(payload).alias("text"))


@register("mapped_clusters", "SELECT c_custkey, n_name AS author_cell_set, CAST(n_regionkey AS BIGINT) AS size, 'u' || n_nationkey AS uuid FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey <> 3")
def mapped_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mappings with size and uuid of the cluster that they name; those that name none are left out, and their own uuid is."""
    nation = D.table(spark, sf_dir, "nation")
    mappings = D.table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("author_cell_set"), F.lit("own").alias("uuid"))
    clusters = nation.where("n_nationkey <> 3").select(F.col("n_name").alias("clusterName"), F.col("n_regionkey").cast("long").alias("clusterSize"), F.concat(F.lit("u"), "n_nationkey").alias("uuid"))
    return S.with_clusters(mappings, clusters).select("c_custkey", "author_cell_set", F.col("clusterSize").alias("size"), "uuid")


@register(
    "silhouette_tuples",
    f"""WITH v AS (SELECT o_custkey AS k, median(o_totalprice) AS median, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS std, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= 10)
    SELECT '{P}CS_' || k || '-u' || k AS s, '{RDF}' || unnest(['silhouette_score', 'median_silhouette', 'mean_silhouette', 'standard_deviation_of_silhouette', 'first_quartile_silhouette', 'third_quartile_silhouette']) AS p, CAST(CAST(floor(unnest([median, median, mean, std, q1, q3]) + 0.0001) AS BIGINT) AS VARCHAR) AS o FROM v""",
)
def silhouette_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of clusters joined by the column that names them, as attributes of cell sets; customers stand for clusters, prices for scores."""
    price = F.col("o_totalprice")
    score = {"median": F.median(price), "mean": F.avg(price), "std": F.stddev_samp(price), "q1": F.percentile(price, 0.25), "q3": F.percentile(price, 0.75)}
    orders = D.table(spark, sf_dir, "orders").groupBy(text("o_custkey").alias("name_of_cluster")).agg(F.count("*").alias("size"), *[text(F.floor(c.cast("double") + 0.0001)).alias(k) for k, c in score.items()])
    key = text("c_custkey")
    clusters = S.with_scores(D.table(spark, sf_dir, "customer").select(key.alias("clusterName"), F.concat(F.lit("u"), key).alias("uuid")), orders, "name_of_cluster")
    none = F.lit(None).cast("string")
    rows = clusters.select(F.col("clusterName").alias("cluster"), "uuid", "size", *score, none.alias("f_score"), F.array().cast("array<string>").alias("markers"), none.alias("dataset"), none.alias("uberon"))
    return T.marker_tuples(rows).where(F.col("p").contains("ilhouette")).select("s", "p", "o")


@register(
    "warned_drugs",
    f"""SELECT DISTINCT '{P}CHEMBL_' || p_partkey AS s, '{P}RO_0002436' AS p, '{P}PR_' || p_size AS o FROM part WHERE p_partkey % 3 > 0
    UNION ALL SELECT '{P}CHEMBL_' || p_partkey, '{RDF}Name', p_name FROM part WHERE p_partkey % 3 > 0""",
)
def warned_drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drugs without a warning that they were withdrawn; other warnings, and none at all, don't matter."""
    key = F.col("p_partkey")
    warnings = F.when(key % 3 == 0, F.array(F.lit("Boxed"), F.lit("Withdrawn"))).when(key % 3 == 1, F.array(F.lit("Boxed")))
    drug = F.struct(text(key).alias("id"), F.col("p_name").alias("name"), F.lit("APPROVAL").alias("phase"), F.lit(False).alias("withdrawn"), F.array().cast("array<string>").alias("trials"), warnings.alias("warnings"))
    diseases = F.array().cast("array<struct<id:string,name:string,score:double>>")
    rows = D.table(spark, sf_dir, "part").select(text(key).alias("gene"), text("p_size").alias("protein"), diseases.alias("diseases"), F.array(drug).alias("drugs"))
    return T.target_tuples(rows).where("arity = 3").select("s", "p", "o")
