"""Older rules on small tables: the property graph, strict checks, flags and inserts."""

import pytest

from weftgraph.operators import graph_build as B
from weftgraph.operators import lookups as L

P = "http://purl.obolibrary.org/obo/"


def test_legacy_graph(spark):
    triples = [(1, "A_1", "x#rel", "B_1"), (2, "A_1", "x#late", "B_1"), (3, "A_1", "x#label", "one"), (4, "A_1", "x#label", "two"), (5, "A_1", "x#label", "one"), (6, "B_1", "y/rel", "A_1"), (7, "C_1", "x#rel", "A_1"), (8, "A_9", "x#label", "alone"), (9, "A_1", "x#rel", None)]
    rows = [(i, P + s, p, P + o if o in ("A_1", "B_1") else o) for i, s, p, o in triples]
    quads = [(1, P + "A_1", P + "B_1", "weight", "2"), (2, P + "A_1", P + "B_1", "weight", "1"), (3, P + "A_1", P + "A_9", "weight", "no edge"), (4, P + "A_1", P + "B_1", "note", "n")]
    v, e = B.legacy_graph(spark.createDataFrame(rows, "seq long, s string, p string, o string"), spark.createDataFrame(quads, "seq long, s string, o string, attr string, value string"), ("A", "B"))
    assert {r["term"]: r["attrs"] for r in v.collect()} == {"A_1": {"label": ["one", "two"]}, "B_1": {}, "A_9": {"label": ["alone"]}}
    assert {(r["collection"], r["key"]): (r["src"], r["dst"], r["label"], r["attrs"]) for r in e.collect()} == {
        ("A-B", "1-1"): ("A/1", "B/1", "rel", {"note": ["n"], "weight": ["2", "1"]}),
        ("B-A", "1-1"): ("B/1", "A/1", "rel", {}),
    }


def test_strict_checks_fail_the_job(spark):
    rows = spark.createDataFrame([(3, P + "A_1", P + "p", "o", None, None), (3, "no", P + "p", "o", None, None)], "arity int, s string, p string, o string, attr string, value string")
    good, bad = B.checked(rows)
    assert good.count() == 1 and [r["problem"] for r in bad.collect()] == ["subject"]
    with pytest.raises(Exception, match="malformed subject"):
        B.checked(rows, strict=True)[0].collect()
    assert B.checked(rows.limit(1), strict=True)[0].count() == 1


def test_flags_and_drops(spark):
    rows = spark.createDataFrame([(1, "MONDO_1"), (2, "CL_1"), (3, "MONDO_2"), (4, None)], "k int, term string")
    found = L.flagged(rows, "term", spark.createDataFrame([("MONDO_1",), ("CL_1",), ("CL_1",), (None,)], "term string"))
    assert sorted((r["k"], r["deprecated"]) for r in found.collect()) == [(2, True), (3, False), (4, False)]


def test_edges_are_inserted_or_replaced(spark):
    schema = "collection string, key string, src string, dst string, labels array<string>"
    old = spark.createDataFrame([("A-B", "1", "A/1", "B/1", ["old"])], schema)
    new = spark.createDataFrame([("A-B", "1", "A/1", "B/1", ["new"]), ("A-B", "2", "A/1", "B/2", ["new"]), ("A-B", "3", "A/1", "B/9", ["new"])], schema)
    ends = spark.createDataFrame([("A", "1"), ("B", "1"), ("B", "2")], "collection string, key string")
    state = lambda update: {r["key"]: r["labels"] for r in B.upsert_edges(old, new, ends, update).collect()}
    assert state(True) == {"1": ["new"], "2": ["new"]} and state(False) == {"1": ["old"], "2": ["new"]}
