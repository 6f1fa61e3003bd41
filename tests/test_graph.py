"""The 12-vertex golden graph, by hand."""

import pytest

from weftgraph.operators import graph_query as G

# fixed values: the vertices and edges of the golden graph
VERTICES = ["CS/1", "CL/1", "CL/2", "GO/1", "GO/2", "CHEMBL/1", "PR/1", "PR/2", "CHEBI/1", "NCT/1", "UBERON/1", "UBERON/2"]
EDGES = [
    ("e1", "CS/1", "CL/1", "X"),
    ("e2", "CL/1", "GO/1", "X"),
    ("e3", "CL/1", "CL/2", "SUB_CLASS_OF"),
    ("e4", "GO/1", "GO/2", "SUB_CLASS_OF"),
    ("e5", "CHEMBL/1", "CL/1", "X"),
    ("e6", "CHEMBL/1", "PR/1", "X"),
    ("e7", "CS/1", "CHEBI/1", "X"),
    ("e8", "CHEBI/1", "PR/2", "X"),
    ("e9", "CS/1", "NCT/1", "X"),
    ("e10", "CS/1", "UBERON/1", "X"),
    ("e11", "UBERON/1", "UBERON/2", "PART_OF"),
]


@pytest.fixture(scope="module")
def graph(spark):
    vertices = spark.createDataFrame([tuple(v.split("/")) for v in VERTICES], "collection string, key string")
    rows = [(f"{a.split('/')[0]}-{b.split('/')[0]}", k, a, b, [label]) for k, a, b, label in EDGES]
    return vertices, spark.createDataFrame(rows, "collection string, key string, src string, dst string, labels array<string>")


def column(frame, name):
    return {r[name] for r in frame.collect()}


def test_find(graph):
    found, among = G.find(*graph, "CS", 10)
    assert column(found, "id") == {"CS/1", "CL/1", "GO/1", "CHEMBL/1", "PR/1", "UBERON/1"}
    assert column(among, "key") == {"e1", "e2", "e5", "e6", "e10"}
    assert column(G.find(*graph, "CS", 1)[0], "id") == {"CS/1", "CL/1", "UBERON/1"}
    assert {(r.id, r.depth) for r in found.collect()} >= {("CS/1", 0), ("CL/1", 1), ("GO/1", 2)}


def test_enrich(graph):
    found, among = G.find(*graph, "CS", 10)
    ids, edges = G.enrich(*graph, found, among)
    assert column(ids, "id") == {"CS/1", "CL/1", "GO/1", "CHEMBL/1", "PR/1", "UBERON/1", "CL/2", "GO/2", "UBERON/2"}
    assert column(edges, "key") == {"e1", "e2", "e5", "e6", "e10", "e3", "e4", "e11"}


def test_paths_do_not_use_an_edge_twice(graph):
    paths = G.typed_paths(graph[1], "CS", ("CL", "CHEMBL", "PR"))
    assert [r.vertices for r in paths.collect()] == [["CS/1", "CL/1", "CHEMBL/1", "PR/1"]]
    assert G.typed_paths(graph[1], "CS", ("CL", "CS")).count() == 0


def test_longest_chain(graph, spark):
    starts = spark.createDataFrame([("GO/1",), ("GO/2",)], "id string")
    found = G.longest_chains(G.hierarchy_edges(graph[1]), starts)
    assert {r.start: r.chain for r in found.collect()} == {"GO/1": ["GO/1", "GO/2"], "GO/2": ["GO/2"]}


def test_cycles_end(spark):
    edges = spark.createDataFrame([("GO-GO", str(k), f"GO/{k}", f"GO/{(k + 1) % 3}", ["SUB_CLASS_OF"]) for k in range(3)], "collection string, key string, src string, dst string, labels array<string>")
    starts = spark.createDataFrame([("GO/0",)], "id string")
    ids, met = G.ancestors(G.hierarchy_edges(edges), starts)
    assert column(ids, "id") == {"GO/0", "GO/1", "GO/2"} and met.count() == 3
    assert G.reach(G.adjacency(edges), starts, 5).count() == 1  # only edges of one collection with itself


def test_valid_terms_are_those_of_parse_term(spark):
    from pyspark.sql import functions as F

    from weftgraph.functions import terms

    base = terms.PURL
    uris = [base + x for x in ("CL_1", "CL_1_", "CL:1", "CL_1_2", "CL_", "_1", "CL_a b", "GO_1", "CL%5F2", "x/CL_3", "CL_3#y", "CL_3?z")] + ["http://x.org/CL_7", "https://x.org/a/pcl/CS1", "http://ensembl/ENSG9", "no uri", "", None, "http://x.org/pcl/CS_2_3"]
    valid = ("CL", "PCLCS", "ENSG")
    rows = spark.createDataFrame([(u,) for u in uris], "u string")
    t = terms.parse_term(F.col("u"), valid)
    wanted = F.when(t["is_valid"], F.concat_ws("_", t["id"], t["number"]))
    for r in rows.select("u", wanted.alias("wanted"), terms.valid_term(F.col("u"), valid).alias("term")).collect():
        assert r["term"] == r["wanted"], r
