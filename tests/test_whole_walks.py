"""Walks from all vertices and with the operator's depth, against brute force over the edges of the smallest tables."""

import pytest
from conftest import TINY

import __spark_entry__ as entry
from weftgraph.operators.graph_query import MAX_DEPTH
from weftgraph.plans.graph_queries import edges, flat, vertices


@pytest.fixture(scope="module")
def graph(spark):
    rows = [(r.collection, r.key, r.src, r.dst, r.label) for r in flat(edges(spark, TINY)).collect()]
    return {(r.collection, r.key) for r in vertices(spark, TINY).collect()}, rows


@pytest.fixture(scope="module")
def reached(graph):
    near = {}
    for collection, _, a, b, _ in graph[1]:
        left, right = collection.split("-")
        if left != right and collection != "PART-SUPP":
            for x, y in ((a, b), (b, a)):
                if not y.startswith("REGION/"):
                    near.setdefault(x, set()).add(y)
    depth = {f"SUPP/{k}": 0 for c, k in graph[0] if c == "SUPP"}
    front = set(depth)
    for hop in range(1, MAX_DEPTH + 1):
        front = {b for a in front for b in near.get(a, ())} - set(depth)
        depth |= dict.fromkeys(front, hop)
    return depth


def run(spark, name):
    return entry.queries()[name](spark, TINY).collect()


def above(rows, collection, starts):
    up = {}
    for c, _, a, b, _ in rows:
        if c == collection:
            up.setdefault(a, set()).add(b)
    seen, front = set(starts), set(starts)
    while front:
        front = {b for a in front for b in up.get(a, ())} - seen
        seen |= front
    return seen, up


def test_search_goes_on_to_the_parts(spark, graph, reached):
    found = {r.id: r.depth for r in run(spark, "breadth_first_search_whole")}
    assert found == reached
    assert max(reached.values()) > 2 and any(x.startswith("PART/") for x in reached)


def test_induced_subgraph(spark, graph, reached):
    wanted = sorted(r for r in graph[1] if r[2] in reached and r[3] in reached)
    assert sorted((r.collection, r.key, r.src, r.dst, r.label) for r in run(spark, "induced_subgraph_whole")) == wanted


def test_enriched_subgraph(spark, graph, reached):
    parts, _ = above(graph[1], "PART-PART", [x for x in reached if x.startswith("PART/")])
    nations = {f"NATION/{k}" for c, k in graph[0] if c == "NATION"}
    turns, _ = above(graph[1], "TURN-TURN", [x for x in reached if x.startswith("TURN/")])
    assert {r.id for r in run(spark, "enriched_subgraph_whole")} == set(reached) | parts | nations | turns


@pytest.mark.parametrize(("name", "collection"), [("ancestor_walk_whole", "PART"), ("ancestor_edges_whole", "TURN")])
def test_ancestors(spark, graph, name, collection):
    seen, _ = above(graph[1], f"{collection}-{collection}", [f"{c}/{k}" for c, k in graph[0] if c == collection])
    wanted = sorted(r[1] for r in graph[1] if r[0] == f"{collection}-{collection}" and r[2] in seen)
    assert sorted(r.key for r in run(spark, name)) == wanted


def test_longest_chains(spark, graph):
    wanted = {}
    parts = {k for c, k in graph[0] if c == "PART"}
    up = above(graph[1], "PART-PART", [])[1]
    for k in parts:
        chain = [f"PART/{k}"]
        while up.get(chain[-1]):
            chain.append(min(up[chain[-1]]))
        wanted[chain[0]] = " ".join(chain)
    assert {r.start: r.chain for r in run(spark, "longest_chains_whole")} == wanted
