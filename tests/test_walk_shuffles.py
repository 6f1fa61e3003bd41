"""Walks over collections that are named and over ones that aren't, with few and with many vertices; what they join."""

import pytest

from weftgraph.operators import graph_query as G
from weftgraph.plans.iterate import step

EDGES = [
    ("A-B", "A/1", "B/1"), ("A-B", "A/2", "B/2"), ("B-C", "B/1", "C/1"), ("B-C", "B/3", "C/1"), ("C-C", "C/1", "C/2"),
    ("A-C", "A/2", "C/9"), ("D-C", "D/1", "C/1"), ("B-E", "B/1", "E/1"), ("D-E", "D/1", "E/1"), ("F-G", "F/1", "G/1"),
]


def graph(spark, odd=()):
    rows = [(c, f"{a}-{b}", a, b, ["X"]) for c, a, b in (*EDGES, *odd)]
    return step(spark.createDataFrame(rows, "collection string, key string, src string, dst string, labels array<string>"))


def by_hand(edges, starts, depth, ignored):
    found, frontier = dict.fromkeys(starts, 0), set(starts)
    for hop in range(1, depth + 1):
        near = {y for c, a, b in edges for x, y in ((a, b), (b, a)) if x in frontier and len(set(c.split("-"))) == 2 and not y.startswith(ignored)}
        frontier = near - found.keys()
        found |= dict.fromkeys(frontier, hop)
    return found, sorted((a, b) for _, a, b in edges if a in found and b in found)


@pytest.mark.parametrize(("sent", "odd", "depth"), ((0, (), 10), (100, (), 2), (0, (("X-Y", "A/1", "Z/1"), ("Y-X", "Z/1", "C/9")), 10)))
def test_walks_by_collections(spark, monkeypatch, sent, odd, depth):
    """Whether vertices are sent or shuffled, and whether collections name the ends of their edges or not."""
    monkeypatch.setattr(G, "SENT", sent)
    edges = graph(spark, odd)
    assert (G.kinds(edges) is None) == bool(odd)
    starts = spark.createDataFrame([("A/1",)], "id string")
    found = G.reach(G.adjacency(edges, ("E",), ()), starts, depth)
    wanted, among = by_hand([*EDGES, *odd], ["A/1"], depth, "E/")
    assert {r.id: r.depth for r in found.collect()} == wanted
    assert sorted((r.src, r.dst) for r in G.induced(edges, found).collect()) == among
    each = G.reach_each(G.adjacency(edges, ("E",), ()), spark.createDataFrame([("A/1",), ("D/1",)], "id string"), depth)
    both = {(s, *x) for s in ("A/1", "D/1") for x in by_hand([*EDGES, *odd], [s], depth, "E/")[0].items()}
    assert {(r.source, r.id, r.depth) for r in each.collect()} == both


def test_whole_collections_need_no_join(spark, monkeypatch):
    """Edges, which are wide, aren't joined where all their ends are among the vertices."""
    monkeypatch.setattr(G, "SENT", 0)
    edges = graph(spark)
    ids = step(edges.selectExpr("src AS id").union(edges.selectExpr("dst")).distinct())
    found = G.induced(edges, ids)
    assert found.count() == len(EDGES)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


HIERARCHIES = {
    "tree": {"b": "a", "c": "b", "d": "b", "e": "d"},
    "ways of several lengths": {"b": "a", "c": "ab", "d": "bc", "e": "xd", "x": "y", "f": "ac", "g": "ay"},
    "a cycle beside": {"b": "a", "p": "q", "q": "p", "r": "p"},
}


@pytest.mark.parametrize(("name", "most"), (("tree", 64), ("tree", 2), ("ways of several lengths", 64), ("a cycle beside", 64)))
def test_chains_share_what_is_above(spark, name, most):
    above = HIERARCHIES[name]

    def longest(v, passed=()):
        ways = [[v, *longest(w, (*passed, v))] for w in above.get(v, "") if w not in (*passed, v) and len(passed) < most]
        return min(ways, key=lambda c: (-len(c), c), default=[v])

    edges = spark.createDataFrame([(v, w) for v, ws in above.items() for w in ws], "src string, dst string")
    vertices = sorted({*above, *"".join(above.values())})
    found = G.longest_chains(edges, spark.createDataFrame([(v,) for v in [*vertices, vertices[0], "alone"]], "id string"), most)
    assert sorted((r.start, r.chain) for r in found.collect()) == sorted((v, longest(v)) for v in [*vertices, "alone"])


def test_chains_grow_from_the_top(spark, monkeypatch):
    """No walk from every start, whose rows are as many as starts times heights."""
    monkeypatch.setattr(G, "_chains_by_walks", lambda *_: pytest.fail("walked from every start"))
    edges = spark.createDataFrame([(str(k), str(k // 2)) for k in range(1, 64)], "src string, dst string")
    found = G.longest_chains(edges, spark.createDataFrame([(str(k),) for k in range(64)], "id string"))
    assert {r.start: len(r.chain) for r in found.collect()} == {str(k): k.bit_length() + 1 for k in range(64)}


def test_set_difference_is_one_aggregation(spark):
    from weftgraph.operators.reports import set_difference

    frame = lambda rows: spark.createDataFrame(rows, "k long, v string")
    found = set_difference(frame([(1, "a"), (1, "a"), (2, None), (3, "c")]), frame([(2, None), (3, "d"), (1, "a")]))
    assert sorted(map(str, found.toPandas().values.tolist())) == sorted(map(str, [[1, "a", "both"], [2, None, "both"], [3, "c", "old"], [3, "d", "new"]]))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_tasks_of_gene_tuples_grow_with_genes(spark, monkeypatch):
    from conftest import TINY

    from weftgraph.plans import table_queries

    monkeypatch.setattr(table_queries, "GENES_OF_TASK", 10, raising=False)
    plan = table_queries.gene_tuples(spark, TINY)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and ", 21" in plan
