import json

from pyspark.sql import functions as F

from weftgraph.functions import terms
from weftgraph.operators import graph_build, reports, sinks
from weftgraph.sources import files
from weftgraph.streaming import ingest

OWL = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:obo="http://purl.obolibrary.org/obo/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<owl:Ontology rdf:about="http://purl.obolibrary.org/obo/xx.owl"><owl:versionIRI rdf:resource="http://x/2024-02-03/xx.owl"/><dc:title>Things</dc:title><owl:imports rdf:resource="http://x/ro.owl"/></owl:Ontology>
<owl:Class rdf:about="http://purl.obolibrary.org/obo/XX_1"><rdfs:label xml:lang="en">one</rdfs:label>
<rdfs:subClassOf rdf:resource="http://purl.obolibrary.org/obo/XX_2"/><rdfs:subClassOf rdf:resource="http://purl.obolibrary.org/obo/YY_9"/>
<rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="http://purl.obolibrary.org/obo/RO_0002202"/><owl:someValuesFrom rdf:resource="http://purl.obolibrary.org/obo/XX_3"/></owl:Restriction></rdfs:subClassOf></owl:Class>
<owl:Class rdf:about="http://purl.obolibrary.org/obo/XX_2"><rdfs:label>two</rdfs:label><owl:deprecated>true</owl:deprecated><obo:IAO_0000115>007</obo:IAO_0000115><rdfs:seeAlso rdf:resource="http://purl.obolibrary.org/obo/XX_1"/><rdfs:seeAlso rdf:resource="http://x/YY_1"/><dc:date>1.10</dc:date></owl:Class>
<owl:Class rdf:about="http://purl.obolibrary.org/obo/YY_9"><rdfs:label>other</rdfs:label><obo:IAO_0000115>of another namespace</obo:IAO_0000115></owl:Class>
<owl:ObjectProperty rdf:about="http://purl.obolibrary.org/obo/RO_0002202"><rdfs:label>develops from</rdfs:label></owl:ObjectProperty>
</rdf:RDF>"""


def test_ontology(spark, tmp_path):
    path = tmp_path / "xx.owl"
    path.write_text(OWL)
    classes, headers = files.ontology_classes(spark, str(path)), files.ontology_headers(spark, str(path))
    header = headers.first()
    assert (header.title, header.version, header.imports) == ("Things", "2024-02-03", ["RO"])
    spaces = files.root_namespaces(classes, headers)
    assert spaces.first().namespaces == ["http://purl.obolibrary.org/obo/XX"]
    # without a root the first class of the file counts, not the first by name
    assert files.root_namespaces(classes.where("about LIKE '%Y_9' OR about LIKE '%X_2'"), headers).first().namespaces == ["http://purl.obolibrary.org/obo/XX"]
    found = {(r.s[-4:], r.p.split("/")[-1], r.o.split("/")[-1]) for r in files.ontology_triples(classes, spaces).collect()}
    assert found == {("XX_1", "rdf-schema#label", "one"), ("XX_1", "rdf-schema#subClassOf", "XX_2"), ("XX_1", "RO_0002202", "XX_3"), ("XX_2", "rdf-schema#label", "two")}  # owl: isn't among the kept predicates
    statements = files.statement_triples(files.ontology_statements(spark, str(path)), files.prefixes(spark, str(path)), spaces)
    kept = {(r.s[-4:], r.p.split("/")[-1], r.o.split("/")[-1]) for r in statements.collect()}
    assert kept == {("XX_1", "rdf-schema#label", "one"), ("XX_1", "rdf-schema#subClassOf", "XX_2"), ("XX_2", "rdf-schema#label", "two"), ("XX_2", "IAO_0000115", "007"), ("XX_2", "rdf-schema#seeAlso", "XX_1"), ("XX_2", "date", "1.10")}
    elements = files.ontology_terms(spark, str(path))
    assert {r.file: r.ids for r in files.term_ids(elements).collect()} == {"xx.owl": ["RO", "XX", "YY"]}
    assert {(r.namespace[-2:], r.is_root) for r in files.class_namespaces(classes, spaces).collect()} == {("XX", True), ("YY", False)}
    labels = files.term_labels(elements)
    assert {r.term: r.label for r in labels.collect()} == {"XX_1": "one", "XX_2": "two", "YY_9": "other", "RO_0002202": "develops from"}
    both = files.term_labels(elements.union(elements.withColumn("file", F.lit("ro.owl")).where("about LIKE '%RO_%'")))
    assert {r.term: r.label for r in both.collect()}["IAO_0000136"] == "is about"
    slim = files.slimmed(classes, headers, files.ontology_statements(spark, str(path), "owl:ObjectProperty"), "http://purl.obolibrary.org/obo/XX_3")
    assert slim[0].count() == 1 and slim[2].first().literal == "develops from" and slim[3].first().kept == 1
    assert [r.about[-4:] for r in files.taxon_slim(classes, "http://purl.obolibrary.org/obo/XX_3").collect()] == ["XX_1"]
    assert files.files_matching(spark, str(tmp_path), r"x+\.owl").count() == 1


def test_tuple_files_and_keyed_json(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"tuples": [["http://a/A_1", "http://p", "http://b/B_2"], ["x", "http://p", "y"], ["http://a/A_1", "http://p", "http://b/B_2", "http://q#Score", "1"], ["a", "b", "c", "d"]]}))
    read = files.tuple_files(spark, str(tmp_path / "t.json"))
    checked = graph_build.validate(read)
    assert [(r.seq, r.arity, r.problem) for r in checked.orderBy("seq").collect()] == [(0, 3, None), (1, 3, "subject"), (2, 5, None), (3, 4, None)]
    sinks.write_tuples(read, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().tuples[2][3:] == ["http://q#Score", "1"]
    (tmp_path / "k.json").write_text(json.dumps({"a": {"x": 1}, "b": {"x": 2}, "ids": ["a", "b"]}))
    assert {r.id for r in files.keyed_json(spark, str(tmp_path / "k.json"), "ids").select("id").collect()} == {"a", "b"}


def test_result_table(spark, tmp_path):
    (tmp_path / "r.csv").write_text(',clusterName,clusterSize,NSForest_markers\n0,c1,12,"[\'A\', \'B\']"\n1,c2,3,"[]"\n')
    found = files.result_table(spark, str(tmp_path / "r.csv"), "_c0 string, clusterName string, clusterSize long, NSForest_markers string")
    rows = found.withColumn("m", terms.string_list(F.col("NSForest_markers"))).orderBy("clusterName").collect()
    assert [r.m for r in rows] == [["A", "B"], []] and all(len(r.uuid) == 12 for r in rows) and rows[0].uuid != rows[1].uuid


def test_terms(spark):
    uris = ["http://x/CL_0000235", "http://x/GS_A_B", "http://x/A_", "http://x/A_B_", "http://x/PUB_10.1/test", "http://x/a b_1", "http://x/pcl/CS1", "http://x/ensembl/ENSG5", "http://x/X:7", None]
    got = spark.createDataFrame([(u,) for u in uris], "u string").select(terms.parse_term(F.col("u"), ("CL", "A", "X")).alias("t")).collect()
    assert [(r.t.id, r.t.number, r.t.is_valid) for r in got] == [("CL", "0000235", True), (None, None, False), (None, None, False), ("A", "B", True), (None, None, False), (None, None, False), ("PCLCS", "1", False), ("ENSG", "5", False), ("X", "7", True), (None, None, False)]


def test_graph_sinks(spark, tmp_path):
    vertices = spark.createDataFrame([("A", "1", {"label": ["x", "y"], "_rev": ["z"]})], "collection string, key string, attrs map<string,array<string>>")
    edges = spark.createDataFrame([("A-B", "1-p-2", "A/1", "B/2", ["P"])], "collection string, key string, src string, dst string, labels array<string>")
    sinks.write_graph(vertices, edges, str(tmp_path / "g"))
    v, e = files.graph_tables(spark, str(tmp_path / "g"))
    assert v.first().attrs == {"label": ["x", "y"]} and e.count() == 1
    assert reports.edge_definitions(e).first().to_collections == ["B"]
    assert sinks.n_triples(edges, "http://b/").first().value == "<http://b/A_1> <http://b/P> <http://b/B_2> ."
    assert sinks.routed(sinks.node_table(vertices)).first().key == "1"


def test_stream_equals_batch(spark, tmp_path):
    rows = [[(0, 1, "A", "1", "x", "old"), (0, 1, "A", "2", "x", "b")], [(0, 2, "A", "1", "x", "new"), (1, 0, "B", "3", "y", "c")]]
    frames = [spark.createDataFrame(r, ingest.SCHEMA) for r in rows]
    for k, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = ingest.last_by_key(None, frames[0].unionByName(frames[1]))
    assert set(ingest.current(spark, str(tmp_path / "out")).collect()) == set(batch.collect())
