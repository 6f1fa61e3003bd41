"""Registered queries of structures that are written and read back - streamed graphs, ordered tuple files, slims, search indexes -
of associations, members of path patterns, blank nodes and differences of bags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.operators import associations as A
from weftgraph.operators import search_index as index
from weftgraph.operators import namespaces as N
from weftgraph.operators import patterns as M
from weftgraph.operators import reports as R
from weftgraph.operators import keyed_store, sinks, slims
from weftgraph.operators import writers as T
from weftgraph.plans.graph_queries import LINKS, LITERALS, edges
from weftgraph.plans.iterate import remove, sparing
from weftgraph.plans.more_queries import folder
from weftgraph.plans.registry import register
from weftgraph.sources import derived as D
from weftgraph.sources import files
from weftgraph.streaming import edges as stream

P, RDF = T.PURL, T.RDF

PRESENT = "present AS (SELECT DISTINCT collection || '/' || key AS id FROM literals WHERE value IS NOT NULL)"


def streamed(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the graph that a stream made of three batches of files: most edges come in another batch than their ends.

    Files come a batch at a time and are removed once they are taken in.
    """
    source, out, checkpoint = folder(spark), folder(spark), folder(spark)
    rows = D.literals(spark, sf_dir).unionByName(D.links(spark, sf_dir))
    file = F.pmod(F.xxhash64("s", "p", "o"), F.lit(3))
    for k in range(3):  # as many files each as the rows have partitions
        with sparing(spark):
            rows.where(file == k).write.mode("append").parquet(source)
        many = len(spark.read.schema(stream.TUPLES).parquet(source).inputFiles())
        stream.ingest(spark, source, out, checkpoint, D.VALID, D.predicate_labels(spark), many).awaitTermination()
        remove(spark, source)
    return out


@register(
    "streamed_edges",
    f"""WITH {LINKS}, {LITERALS}, {PRESENT},
    known AS (SELECT edges.*, CASE WHEN a.id IS NULL THEN src WHEN b.id IS NULL THEN dst END AS missing FROM edges LEFT JOIN present a ON a.id = src LEFT JOIN present b ON b.id = dst)
    SELECT collection, key, src, dst, label, missing FROM known""",
)
def streamed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges taken in by a stream, file by file: those with both ends, as in one batch, and those that still wait, with the end they wait for first."""
    out = streamed(spark, sf_dir)
    columns = ["collection", "key", "src", "dst", "label"]
    settled = stream.kept(spark, out, "edges").select(*columns, F.lit(None).cast("string").alias("missing"))
    return settled.union(stream.kept(spark, out, "waiting").select(*columns, "missing").distinct())


# ---- all writers in order, as ordered files

WRITERS_SQL = f"""made AS (
  SELECT 0 AS rank, '{P}UBERON_' || n_nationkey AS s, '{P}BFO_0000050' AS p, '{P}UBERON_' || (100 + n_regionkey) AS o, NULL AS attr, NULL AS value FROM nation
  UNION ALL SELECT 0, '{P}UBERON_' || n_nationkey, '{P}BFO_0000050', '{P}UBERON_' || (100 + n_regionkey), '{RDF}Source', 'HuBMAP' FROM nation
  UNION ALL SELECT 0, '{P}UBERON_' || n_nationkey, '{RDF}Label', n_name, NULL, NULL FROM nation
  UNION ALL SELECT 1, '{P}CL_' || c_custkey, '{P}BFO_0000050', '{P}UBERON_' || c_nationkey, NULL, NULL FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
  UNION ALL SELECT 1, '{P}CL_' || c_custkey, '{P}BFO_0000050', '{P}UBERON_' || c_nationkey, '{RDF}Source', 'HuBMAP' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
  UNION ALL SELECT 2, '{P}GS_' || replace(p_name, ' ', '-'), '{P}RO_0003000', '{P}PR_' || p_size, NULL, NULL FROM part
  UNION ALL SELECT 2, '{P}GS_' || replace(p_name, ' ', '-'), '{P}RO_0003000', '{P}PR_' || p_size, '{RDF}Source', 'UniProt' FROM part
  UNION ALL SELECT 2, '{P}GS_' || replace(p_name, ' ', '-'), '{RDF}Brand', p_brand, NULL, NULL FROM part
  UNION ALL SELECT 3, '{P}UBERON_' || n_nationkey, '{RDF}Label', n_name || '!', NULL, NULL FROM nation WHERE n_nationkey % 2 = 0
  UNION ALL SELECT 3, '{P}UBERON_' || n_nationkey, '{P}BFO_0000050', '{P}UBERON_' || (100 + n_regionkey), NULL, NULL FROM nation WHERE n_nationkey % 2 = 0
  UNION ALL SELECT 3, '{P}UBERON_' || n_nationkey, '{P}BFO_0000050', '{P}UBERON_' || (100 + n_regionkey), '{RDF}Source', 'HuBMAP' FROM nation WHERE n_nationkey % 2 = 0),
last AS (
  SELECT s, p, arg_max(o, row(rank, o)) AS o, NULL AS attr, NULL AS value FROM made WHERE attr IS NULL AND starts_with(p, '{RDF}') GROUP BY s, p
  UNION ALL SELECT DISTINCT s, p, o, attr, value FROM made WHERE attr IS NOT NULL OR NOT starts_with(p, '{RDF}'))"""


@register("writer_pipeline", f"WITH {WRITERS_SQL} SELECT s, p, o, attr, value FROM last")
def writer_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All writers in their order, the last annotation of a subject kept, written as ordered files of 500 tuples and read back."""
    read = lambda name: D.table(spark, sf_dir, name)
    nations = lambda rows, mark: rows.select(F.concat(F.lit("UBERON:"), "n_nationkey").alias("id"), F.concat("n_name", F.lit(mark)).alias("label"), F.array(F.concat(F.lit("UBERON:"), F.col("n_regionkey") + 100)).alias("part_of"))
    cells = read("customer").select(F.concat(F.lit("CL:"), "c_custkey").alias("id"), F.array(F.concat(F.lit("UBERON:"), "c_nationkey")).alias("located_in"))
    known = read("orders").where("o_orderstatus = 'P'").select(F.concat(F.lit("CL:"), "o_custkey").alias("id"))
    genes = read("part").select(F.replace("p_name", F.lit(" "), F.lit("-")).alias("symbol"), F.col("p_size").cast("string").alias("protein"), F.col("p_brand").alias("Brand"))
    writers = [T.part_of_tuples(nations(read("nation"), "")), T.cell_type_part_of_tuples(cells, known), T.gene_tuples(genes), T.part_of_tuples(nations(read("nation").where("n_nationkey % 2 = 0"), "!"))]
    path = folder(spark)
    T.pipeline(writers, path, per_file=500)
    back = files.ordered_tuples(spark, path)
    three = F.col("arity") == 3
    return back.select("s", "p", "o", F.when(~three, F.col("attr")).alias("attr"), F.when(~three, F.col("value")).alias("value"))


@register("ordered_tuple_files", "SELECT row_number() OVER (ORDER BY event_id) AS place, 'USER_' || user_id AS s, event_type AS p, printf('%.2f', value) AS o FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL")
def ordered_tuple_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as tuples in order of time, in files of 250, read back: the place of each in the order of files and lines."""
    none = F.lit(None).cast("string")
    rows = D.table(spark, sf_dir, "events").where("event_type IS NOT NULL AND value IS NOT NULL")
    tuples = rows.select(F.lit(0).alias("file_rank"), F.col("event_id").alias("seq"), F.concat(F.lit("USER_"), "user_id").alias("s"), F.col("event_type").alias("p"), F.format_string("%.2f", "value").alias("o"), none.alias("attr"), none.alias("value"))
    path = folder(spark)
    sinks.write_ordered(tuples, path, per_file=250)
    back = files.ordered_tuples(spark, path)
    # places are counted within a file, and files follow each other by name: a row for each file
    many = back.groupBy("file").agg(F.count("*").alias("n"))
    before = many.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("file").orderBy("position"))
    return back.join(before, "file").select((F.col("before") + within).alias("place"), "s", "p", "o")


# ---- slims


@register(
    "slim_files",
    f"""SELECT '{P}PART_' || p_partkey AS about, p_name AS label, 'in' AS state FROM part WHERE p_size = 7
    UNION ALL SELECT '{P}taxa.owl', 'header', 'header' UNION ALL SELECT '{P}RO_0002162', 'in taxon', 'property'
    UNION ALL SELECT CAST(count(*) FILTER (p_size = 7) AS VARCHAR), CAST(count(*) FILTER (p_size <> 7) AS VARCHAR), 'counts' FROM part""",
)
def slim_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as an ontology with nested classes and axioms, slimmed to one taxon as a file: its classes, header and property read back, and the counts."""
    about = F.concat(F.lit(f'rdf:about="{P}PART_'), "p_partkey", F.lit('"'))
    nested = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(f'<owl:equivalentClass><owl:Class><rdfs:comment>x</rdfs:comment></owl:Class></owl:equivalentClass><rdfs:subClassOf><owl:Class rdf:about="{P}NOT_'), "p_partkey", F.lit('"/></rdfs:subClassOf>'))).otherwise("")
    taxon = F.concat(F.lit(f'<rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="{P}RO_0002162"/><owl:someValuesFrom rdf:resource="{P}NCBITaxon_'), "p_size", F.lit('"/></owl:Restriction></rdfs:subClassOf>'))
    axiom = F.concat(F.lit(f'<owl:Axiom><owl:annotatedTarget><owl:Class rdf:about="{P}AX_'), "p_partkey", F.lit('"></owl:Class></owl:annotatedTarget></owl:Axiom>'))
    classes = D.table(spark, sf_dir, "part").select(F.concat(F.lit("<owl:Class "), about, F.lit("><rdfs:label>"), "p_name", F.lit("</rdfs:label>"), nested, taxon, F.lit("</owl:Class>\n"), axiom).alias("value"))
    spaces = 'xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#"'
    head = f'<rdf:RDF {spaces}><owl:Ontology rdf:about="{P}taxa.owl"><dc:title>header</dc:title></owl:Ontology><owl:ObjectProperty rdf:about="{P}RO_0002162"><rdfs:label>in taxon</rdfs:label></owl:ObjectProperty>'
    line = lambda value: spark.range(1).select(F.lit(value).alias("value"))
    source, path = folder(spark), folder(spark)
    sinks.write_lines(line(head).union(classes).union(line("</rdf:RDF>")).coalesce(1), "value", source)
    counts = slims.write_slim(spark, source, path, "7", per_file=100)
    slim = f"{path}/file=*"
    found = slims.classes(spark, slim).select("about", F.get("labels", F.lit(0)).alias("label"), F.lit("in").alias("state"))
    header = slims.headers(spark, slim).select("purl", "title", F.lit("header"))
    kinds = slims.terms(spark, slim, ("owl:ObjectProperty",)).select("about", "label", F.lit("property"))
    return found.union(header).union(kinds).union(counts.select(F.col("written").cast("string"), F.col("skipped").cast("string"), F.lit("counts")))


# ---- search


def text_index(spark: SparkSession, sf_dir: str) -> str:
    """The folder of an index of the names of parts, and the texts of benchmark items."""
    field = lambda name, collection, key, column: D.table(spark, sf_dir, name).select(F.lit(collection).alias("collection"), F.col(key).cast("string").alias("key"), F.lit(column).alias("field"), F.col(column).alias("text"))
    path = folder(spark)
    index.write_index(field("part", "PART", "p_partkey", "p_name").unionByName(field("benchmark", "ITEM", "item_id", "text")), path)
    return path


WORDS_SQL = "list_filter(string_split(trim(regexp_replace(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '')"
TEXTS_SQL = f"""texts AS (
  SELECT collection, key, field, w, len(w) AS norm FROM (SELECT collection, key, field, {WORDS_SQL} AS w FROM (
    SELECT 'PART' AS collection, CAST(p_partkey AS VARCHAR) AS key, 'p_name' AS field, p_name AS text FROM part UNION ALL SELECT 'ITEM', CAST(item_id AS VARCHAR), 'text', text FROM benchmark)))"""


@register(
    "phrase_search",
    f"""WITH {TEXTS_SQL}, phrases AS (
      SELECT phrase, string_split(lower(phrase), ' ') AS pw FROM (SELECT split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2) AS phrase FROM part UNION SELECT split_part(p_name, ' ', 1) FROM part)),
    met AS (SELECT phrase, collection, key, field, norm, list_filter(range(1, norm - len(pw) + 2), lambda i: w[i:i + len(pw) - 1] = pw) AS hits FROM phrases JOIN texts ON list_contains(w, pw[1]))
    SELECT phrase, collection, key, field, CAST(len(hits) AS INTEGER) AS n, CAST(list_min(hits) - 1 AS INTEGER) AS first, len(hits) / norm AS score FROM met WHERE len(hits) > 0""",
)
def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases - the first word, and the first two, of every part's name - looked up in a stored index of names and texts."""
    name = D.table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("w"))
    phrases = name.select(F.array_join(F.slice("w", 1, 2), " ").alias("phrase")).union(name.select(F.get("w", F.lit(0)))).distinct()
    return index.phrase_search(spark, text_index(spark, sf_dir), phrases).select("phrase", "collection", "key", "field", "n", "first", "score")


@register(
    "index_postings",
    f"""WITH {TEXTS_SQL}, words AS (SELECT collection, key, field, norm, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS place FROM texts)
    SELECT collection, key, token, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS places, CAST(max(norm) AS INTEGER) AS norm FROM words GROUP BY collection, key, field, token""",
)
def index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All postings of the stored index, decoded: the places of each word in each text, and how many words that has."""
    path = text_index(spark, sf_dir)
    found = index.postings(spark, path).join(spark.read.parquet(f"{path}/documents").drop("norm"), "doc")
    return found.select("collection", "key", "token", F.array_join(F.transform("places", lambda x: x.cast("string")), ",").alias("places"), "norm")


# ---- associations from alternative sources

NO_DATA = {"CellSetExactMatchCellSet": "No cell set matching data"}


def realised(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The best candidates of two associations, and the catalogue: customers' places from their orders or else from themselves, and parts' makers."""
    catalogue = T.catalogue(spark).where(F.col("association").isin("CellTypePartOfAnatomicalStructure", "GeneProducesProtein", "AnatomicalStructurePartOfAnatomicalStructure", *NO_DATA))
    required = F.when(F.col("association") == "CellTypePartOfAnatomicalStructure", F.array(F.lit("label"), F.lit("size"))).otherwise(F.array().cast("array<string>"))
    no_data = F.element_at(F.create_map(*[F.lit(x) for pair in NO_DATA.items() for x in pair]), F.col("association"))
    catalogue = catalogue.union(spark.createDataFrame([(n, None) for n in NO_DATA], "association string, predicate string")).withColumns({"required": required, "no_data": no_data})
    read = lambda name: D.table(spark, sf_dir, name)
    column, key = F.col, F.col("c_custkey")
    orders = read("customer").join(read("orders").where("o_orderstatus <> 'P'"), column("c_custkey") == column("o_custkey"))
    place = F.concat(F.lit("UBERON_"), "c_nationkey")
    made = [
        A.candidates(orders, "CellTypePartOfAnatomicalStructure", "orders", 1, key, F.concat(F.lit("CL_"), key), place, {"label": column("c_name"), "size": F.when(column("o_orderstatus") == "F", column("o_orderkey"))}, column("o_orderkey")),
        A.candidates(read("customer"), "CellTypePartOfAnatomicalStructure", "customer", 2, key, F.concat(F.lit("CL_"), key), F.when(key % 3 > 0, place), {"label": column("c_name"), "size": F.when(key % 3 == 1, key)}, key),
        A.candidates(read("part"), "GeneProducesProtein", "part", 1, column("p_partkey"), F.concat(F.lit("GS_"), "p_partkey"), F.when(column("p_size") > 10, F.concat(F.lit("PR_"), "p_size")), {}, column("p_partkey")),
        A.candidates(read("region"), "Unheard", "region", 1, column("r_regionkey"), column("r_name"), column("r_name"), {}, column("r_regionkey")),
    ]
    rows = made[0].unionByName(made[1]).unionByName(made[2]).unionByName(made[3])
    return A.first_success(A.judged(rows, catalogue)[0]), catalogue


REALISED = """c AS (
  SELECT 'CellTypePartOfAnatomicalStructure' AS association, c_custkey AS key, 'orders' AS source, 1 AS rank, o_orderkey AS seq, 'CL_' || c_custkey AS s, 'UBERON_' || c_nationkey AS o, c_name AS label, CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS size FROM customer JOIN orders ON o_custkey = c_custkey AND o_orderstatus <> 'P'
  UNION ALL SELECT 'CellTypePartOfAnatomicalStructure', c_custkey, 'customer', 2, c_custkey, 'CL_' || c_custkey, CASE WHEN c_custkey % 3 > 0 THEN 'UBERON_' || c_nationkey END, c_name, CASE WHEN c_custkey % 3 = 1 THEN c_custkey END FROM customer
  UNION ALL SELECT 'GeneProducesProtein', p_partkey, 'part', 1, p_partkey, 'GS_' || p_partkey, CASE WHEN p_size > 10 THEN 'PR_' || p_size END, '', 0 FROM part),
judged AS (SELECT *, CASE WHEN o IS NULL THEN 2 WHEN label IS NULL OR size IS NULL THEN 1 ELSE 0 END AS state FROM c),
best AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY association, key ORDER BY state, rank, seq) = 1)"""


@register("ranked_associations", f"WITH {REALISED} SELECT association, CAST(key AS VARCHAR) AS key, source, ['Created', 'Partial', 'Failed'][state + 1] AS status, seq, o AS object, (SELECT count(*) FROM judged j WHERE j.association = best.association AND j.key = best.key) AS tried FROM best")
def ranked_associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources tried in order for each association and key: the first success is kept, or else the first that came furthest."""
    return realised(spark, sf_dir)[0].select("association", "key", "source", "status", "seq", "object", "tried")


@register(
    "association_states",
    f"""WITH {REALISED}, n AS (SELECT association, ['Created', 'Partial', 'Failed'][state + 1] AS status, count(*) AS n FROM best GROUP BY ALL
      UNION ALL SELECT 'AnatomicalStructurePartOfAnatomicalStructure', 'Not handled', 0 UNION ALL SELECT 'CellSetExactMatchCellSet', 'Not possible', 0)
    SELECT status, count(DISTINCT association) AS associations, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM (SELECT unnest(['Created', 'Partial', 'Failed', 'Not possible', 'Not handled']) AS status) LEFT JOIN n USING (status) GROUP BY status""",
)
def association_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over all five states."""
    best, catalogue = realised(spark, sf_dir)
    return A.state_report(A.states(best, catalogue))


@register(
    "created_tuples",
    f"""WITH {REALISED}, t AS (SELECT *, '{P}' || s AS su, '{P}' || o AS ou, '{P}' || CASE association WHEN 'GeneProducesProtein' THEN 'RO_0003000' ELSE 'BFO_0000050' END AS p FROM best WHERE state = 0)
    SELECT su AS s, p, ou AS o, NULL AS attr, NULL AS value FROM t UNION ALL SELECT su, p, ou, '{RDF}Source', source FROM t
    UNION ALL SELECT su, '{RDF}label', label, NULL, NULL FROM t WHERE label <> '' UNION ALL SELECT su, p, ou, '{RDF}size', CAST(size AS VARCHAR) FROM t WHERE association <> 'GeneProducesProtein'""",
)
def created_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuples of the associations that were created, and of no others."""
    return A.created_tuples(realised(spark, sf_dir)[0], subject_fields=("label",), edge_fields=("size",)).select("s", "p", "o", "attr", "value")


# ---- members of path patterns

#: Patterns over the shared tables, in the form of the fixed ones.
PATTERNS = """
SUPP NATION REGION
SUPP NATION CUST
SUPP NATION CUST ORD
SUPP PART ORD
SUPP PART ORD CUST
SUPP REGION NATION
SUPP PART + SUB_CLASS_OF
"""


def members_sql(text: str) -> str:
    """The members of all paths of each pattern, by joins of whole paths."""
    tables, rows = [], []
    for i, (steps, label) in enumerate(M.parsed(text)):
        name = " ".join(steps) + (f" + {label}" if label else "")
        n = len(steps) - 1
        hops = " JOIN ".join(f"n h{k}" + (f" ON h{k}.a = h{k - 1}.b AND h{k}.ca = '{steps[k]}' AND h{k}.cb = '{steps[k + 1]}'" if k else "") for k in range(n))
        tables.append(f"p{i} AS (SELECT h0.a AS v0, {', '.join(f'h{k}.b AS v{k + 1}, h{k}.e AS e{k}' for k in range(n))} FROM {hops} WHERE h0.ca = '{steps[0]}' AND h0.cb = '{steps[1]}')")
        rows += [f"SELECT '{name}' AS pattern, 'vertex' AS kind, v{k} AS id FROM p{i}" for k in range(n + 1)] + [f"SELECT '{name}', 'edge', e{k} FROM p{i}" for k in range(n)]
        if label:
            tables.append(f"u{i} AS (SELECT DISTINCT v{n} AS id FROM p{i} UNION SELECT dst FROM u{i} JOIN edges ON src = u{i}.id AND collection = '{steps[-1]}-{steps[-1]}' AND label = '{label}')")
            rows.append(f"SELECT '{name}', 'vertex', id FROM u{i}")
    both = "n AS (SELECT *, split_part(a, '/', 1) AS ca, split_part(b, '/', 1) AS cb FROM (SELECT collection || '/' || key AS e, src AS a, dst AS b FROM edges UNION ALL SELECT collection || '/' || key, dst, src FROM edges))"
    return f"WITH RECURSIVE {LINKS}, {both}, {', '.join(tables)} {' UNION '.join(rows)}"


@register("pattern_members", members_sql(PATTERNS))
def pattern_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices and edges on the paths of several patterns, some with shared prefixes, one without a path, one with a hierarchy."""
    return M.pattern_members(edges(spark, sf_dir), M.parsed(PATTERNS), repeated=False)


# ---- blank nodes

BNODES = """t AS (
  SELECT '_:o' || o_orderkey AS s, 'x#onProperty' AS p, 'x#p' || o_orderstatus AS o FROM orders UNION ALL SELECT '_:o' || o_orderkey, 'x#someValuesFrom', 'C' || o_custkey FROM orders WHERE o_orderkey % 5 > 0
  UNION ALL SELECT 'O' || o_orderkey, 'x#subClassOf', '_:o' || o_orderkey FROM orders
  UNION ALL SELECT '_:c' || c_custkey, 'x#annotatedSource', 'C' || c_custkey FROM customer UNION ALL SELECT '_:c' || c_custkey, 'x#annotatedProperty', 'x#d' FROM customer UNION ALL SELECT '_:c' || c_custkey, 'x#annotatedTarget', c_name FROM customer
  UNION ALL SELECT '_:c' || c_custkey, 'x#annotatedTarget', 'twice' FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT '_:c' || c_custkey, 'x#hasDbXref', c_mktsegment FROM customer
  UNION ALL SELECT '_:c' || c_custkey, 'x#member', '_:o' || c_custkey FROM customer UNION ALL SELECT '_:c' || c_custkey, 'x#member', 'class' || c_nationkey FROM customer UNION ALL SELECT 'C' || c_custkey, 'x#label', c_name FROM customer)"""


@register(
    "bnode_triples",
    """SELECT 'made' AS state, 'relation' AS kind, 'O' || o_orderkey AS s, 'x#p' || o_orderstatus AS p, 'C' || o_custkey AS o FROM orders WHERE o_orderkey % 5 > 0
    UNION ALL SELECT 'made', 'annotation', 'C' || c_custkey, 'x#d', c_name FROM customer WHERE c_custkey % 4 > 0 UNION ALL SELECT 'made', 'literal', 'C' || c_custkey, 'x#hasDbXref', c_mktsegment FROM customer WHERE c_custkey % 4 > 0
    UNION ALL SELECT 'ignored', 'relation', '_:o' || o_orderkey, 'x#onProperty', 'x#p' || o_orderstatus FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT 'ignored', 'relation', 'O' || o_orderkey, 'x#subClassOf', '_:o' || o_orderkey FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL SELECT 'ignored', CASE WHEN p = 'x#hasDbXref' THEN 'literal' ELSE 'annotation' END, '_:c' || c_custkey, p, o FROM (SELECT c_custkey, unnest(['x#annotatedSource', 'x#annotatedProperty', 'x#annotatedTarget', 'x#annotatedTarget', 'x#hasDbXref']) AS p, unnest(['C' || c_custkey, 'x#d', c_name, 'twice', c_mktsegment]) AS o FROM customer WHERE c_custkey % 4 = 0)
    UNION ALL SELECT 'ignored', 'nested', '_:c' || c_custkey, 'x#member', '_:o' || c_custkey FROM customer UNION ALL SELECT 'ignored', 'class', '_:c' || c_custkey, 'x#member', 'class' || c_nationkey FROM customer""",
)
def bnode_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sets of blank nodes say - relations, annotations, literals beside these - and all that they leave unsaid."""
    o, c = D.table(spark, sf_dir, "orders"), D.table(spark, sf_dir, "customer")
    cat = lambda *parts: F.concat(*[F.lit(x) if i % 2 == 0 else F.col(x) for i, x in enumerate(parts)])
    t = lambda rows, s, p, x: rows.select(s.alias("s"), F.lit(p).alias("p") if isinstance(p, str) else p.alias("p"), x.alias("o"))
    b, d = cat("_:o", "o_orderkey"), cat("_:c", "c_custkey")
    made = [
        t(o, b, "x#onProperty", cat("x#p", "o_orderstatus")), t(o.where("o_orderkey % 5 > 0"), b, "x#someValuesFrom", cat("C", "o_custkey")), t(o, cat("O", "o_orderkey"), "x#subClassOf", b),
        t(c, d, "x#annotatedSource", cat("C", "c_custkey")), t(c, d, "x#annotatedProperty", F.lit("x#d")), t(c, d, "x#annotatedTarget", F.col("c_name")), t(c.where("c_custkey % 4 = 0"), d, "x#annotatedTarget", F.lit("twice")),
        t(c, d, "x#hasDbXref", F.col("c_mktsegment")), t(c, d, "x#member", cat("_:o", "c_custkey")), t(c, d, "x#member", cat("class", "c_nationkey")), t(c, cat("C", "c_custkey"), "x#label", F.col("c_name")),
    ]
    triples = made[0]
    for more in made[1:]:
        triples = triples.unionByName(more)
    found, ignored = R.bnode_triples(R.bnode_sets(triples, lambda node: F.coalesce(node.startswith("class"), F.lit(False))))
    return found.select(F.lit("made").alias("state"), "kind", "s", "p", "o").unionByName(ignored.select(F.lit("ignored").alias("state"), "kind", "s", "p", "o"))


# ---- differences of bags


@register(
    "bag_difference",
    """SELECT c_custkey AS key, '$.deep.deep.list[id=' || c_nationkey || '].name' AS path, 'value' AS problem, c_name AS old, c_name || '!' AS new FROM customer WHERE c_custkey % 5 = 0
    UNION ALL SELECT c_custkey, '$.ids[]', 'length', '3', '2' FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT c_custkey, '$.ids[b]', 'value', 'b,b', 'b' FROM customer WHERE c_custkey % 7 = 0
    UNION ALL SELECT c_custkey, '$.deep.deep.list[id=x].name', 'extra', NULL, 'more' FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, '$.deep.deep.list[id=x].id', 'extra', NULL, 'x' FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey, '$.deep.deep.list[]', 'length', '1', '2' FROM customer WHERE c_custkey % 3 = 0""",
)
def bag_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads whose lists come in another order, and some with other members: only what the lists hold counts."""
    key = F.col("c_custkey")
    item = lambda ident, name: F.struct(ident.cast("string").alias("id"), name.alias("name"))
    doc = lambda ids, items: D.table(spark, sf_dir, "customer").select(key.alias("key"), F.try_parse_json(F.to_json(F.struct(ids.alias("ids"), F.struct(F.struct(items.alias("list")).alias("deep")).alias("deep")))).alias("v"))
    old = doc(F.array(F.lit("a"), F.lit("b"), F.lit("b")), F.array(item(F.col("c_nationkey"), F.col("c_name"))))
    same = item(F.col("c_nationkey"), F.when(key % 5 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")))
    new = doc(F.when(key % 7 == 0, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("b"), F.lit("a"), F.lit("b"))), F.when(key % 3 == 0, F.array(item(F.lit("x"), F.lit("more")), same)).otherwise(F.array(same)))
    return R.bag_difference(old, new, "key", "v")


# ---- names and stores


@register(
    "slot_predicates",
    f"""WITH a AS (SELECT 'A' || p_partkey AS association, CASE WHEN p_partkey % 11 > 0 THEN 's' || (p_partkey % 9) END AS slot FROM part),
    s AS (SELECT 's' || k AS slot, CASE WHEN k % 3 = 0 THEN 'OBO:RO_' || k WHEN k % 3 = 1 THEN 'x:slot' || k WHEN k = 2 THEN 'odd:a' END AS curie FROM (SELECT DISTINCT n_nationkey % 8 AS k FROM nation)),
    r AS (SELECT association, slot, curie, s.slot IS NULL AS none FROM a LEFT JOIN s USING (slot))
    SELECT association, slot, curie, CASE WHEN curie LIKE 'OBO:%' THEN '{P}' || substr(curie, 5) WHEN curie LIKE 'x:%' THEN 'https://x.org/' || substr(curie, 3) END AS predicate,
      CASE WHEN slot IS NULL THEN 'no slot' WHEN none THEN 'no definition of the slot' WHEN curie IS NULL THEN 'neither mapping nor URI' WHEN curie LIKE 'odd:%' THEN 'unknown prefix' END AS problem FROM r""",
)
def slot_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicates of associations by slot, first mapping or URI, and namespace; what can't be resolved has a reason."""
    key = F.col("p_partkey")
    associations = D.table(spark, sf_dir, "part").select(F.concat(F.lit("A"), key).alias("association"), F.when(key % 11 > 0, F.concat(F.lit("s"), key % 9)).alias("slot"))
    k = F.col("k")
    mapped = F.when(k % 3 == 0, F.array(F.concat(F.lit("OBO:RO_"), k), F.lit("x:later"))).otherwise(F.array().cast("array<string>"))
    uri = F.when(k % 3 == 1, F.concat(F.lit("x:slot"), k)).when(k == 2, "odd:a").when(k % 3 == 0, "x:second")
    slots = D.table(spark, sf_dir, "nation").select((F.col("n_nationkey") % 8).alias("k")).distinct().select(F.concat(F.lit("s"), k).alias("slot"), mapped.alias("exact_mappings"), uri.alias("slot_uri"))
    spaces = spark.createDataFrame([("OBO", "https://purl.obolibrary.org/obo/"), ("x", "https://x.org/")], "prefix string, uri string")
    found, rejected = N.predicates_of(associations, slots, spaces)
    return found.withColumn("problem", F.lit(None).cast("string")).unionByName(rejected, allowMissingColumns=True)


@register(
    "longest_namespaces",
    """SELECT key, CASE WHEN k = 0 THEN 'a' WHEN k = 1 THEN 'ab' WHEN k = 2 THEN 'abc' END AS prefix, CASE WHEN k < 3 THEN CAST(key AS VARCHAR) END AS local FROM (SELECT o_orderkey AS key, o_orderkey % 4 AS k FROM orders)""",
)
def longest_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of namespaces that start alike the longest one names a URI."""
    key = F.col("o_orderkey")
    base = F.get(F.array(F.lit("http://a/"), F.lit("http://a/b/"), F.lit("http://a/b/c_"), F.lit("urn:x:")), key % 4)
    rows = D.table(spark, sf_dir, "orders").select(key.alias("key"), F.concat(base, key).alias("u"))
    spaces = spark.createDataFrame([("a", "http://a/"), ("ab", "http://a/b/"), ("abc", "http://a/b/c_"), ("zz", "http://a/b/c_"), ("long", "http://a/b/c_none"), ("e", "")], "prefix string, uri string")
    return N.contracted(rows, "u", spaces).select("key", "prefix", "local")


@register("merged_store", "SELECT CAST(user_id AS VARCHAR) AS id, v AS payload FROM (SELECT user_id, arg_max(CASE WHEN event_type = 'error' THEN '-' ELSE printf('{\"value\":%.2f}', value) END, event_id) AS v FROM events GROUP BY user_id) WHERE v <> '-'")
def merged_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events merged into a store in four turns: the last one of each user holds, an error removes it; a turn done twice changes nothing."""
    payload = F.when(F.col("event_type") != "error", F.format_string('{"value":%.2f}', "value"))
    rows = D.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("id"), payload.alias("payload"), F.col("event_id").alias("seq"))
    most = rows.agg(F.max("seq")).first()[0]
    path = folder(spark)
    for turn in (0, 1, 1, 2, 3):
        keyed_store.merge(rows.where(F.floor(F.col("seq") * 4 / (most + 1)) == turn), path, turn)
    return keyed_store.current(spark, path)
