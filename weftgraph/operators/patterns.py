"""Vertices and edges on the paths of many patterns, found without making a row for any path.

A pattern is a row of collections that a path passes through, each once, and perhaps the label of a hierarchy whose chains
above the last vertex belong to it (of each last vertex the longest one). Vertices are reduced forwards - those that a prefix reaches, once for all patterns
that share it - and then back from the end of each pattern, so what is left lies on a whole path; joins meet vertices with
their edges, and their rows are vertices and edges, never paths. A path can't repeat an edge, as its collections differ.

Edges are written once, as they lie, and by collections of their ends; of the steps only vertices are kept. As an edge is on
a path if a prefix reaches one end and the other leads on, edges of a pattern are read from that table as the result is,
without the few vertices that its filters take out: mostly these leave none, and the edges aren't moved at all.

Defined cases: edges count in either direction; patterns that repeat a collection are refused, as are empty ones; patterns
without a path have no members; a vertex without anything above it has no chain; parallel edges are all members.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.functions import terms
from weftgraph.operators.graph_query import SENT, longest_chains
from weftgraph.plans.iterate import discard, sparing, step

# fixed values: the patterns around cell sets, and after a plus the label of the hierarchy above the last collection
PHENOTYPE = """
CS CSD PUB
CS CL GS
CS CL PR
CS BMC GS
CS BMC BGS
CS UBERON NCBITaxon + SUB_CLASS_OF
CS CL MONDO + SUB_CLASS_OF
CS CL GO + SUB_CLASS_OF
CS CL PATO + SUB_CLASS_OF
CS CL GS RS
CS CL GS CHEMBL
CS CL GS PR
CS BMC GS RS
CS BMC GS CHEMBL
CS BMC GS PR
CS CL PR GS
CS CL PR CHEMBL
CS CL MONDO GS
CS CL MONDO RS
CS CL MONDO CHEMBL
CS BMC GS MONDO + SUB_CLASS_OF
CS CL PR GO + SUB_CLASS_OF
CS CL GO NCBITaxon + SUB_CLASS_OF
CS CL GO HsapDv + SUB_CLASS_OF
CS CL GO UBERON + PART_OF
CS CL PATO UBERON + PART_OF
CS CL GS MONDO CHEMBL
CS CL GS CHEMBL PR
CS CL GS PR CHEMBL
CS BMC GS MONDO CHEMBL
CS BMC GS CHEMBL PR
CS BMC GS PR CHEMBL
CS CL PR GS RS
CS CL PR GS CHEMBL
CS CL PR CHEMBL GS
CS CL MONDO GS RS
CS CL MONDO GS CHEMBL
CS CL MONDO GS PR
CS CL MONDO RS GS
CS CL MONDO CHEMBL GS
CS CL MONDO CHEMBL PR
CS CL GS RS MONDO + SUB_CLASS_OF
CS CL GS CHEMBL MONDO + SUB_CLASS_OF
CS CL GS PR GO + SUB_CLASS_OF
CS BMC GS RS MONDO + SUB_CLASS_OF
CS BMC GS CHEMBL MONDO + SUB_CLASS_OF
CS BMC GS PR GO + SUB_CLASS_OF
CS CL PR GS MONDO + SUB_CLASS_OF
CS CL PR CHEMBL MONDO + SUB_CLASS_OF
"""

Pattern = tuple[tuple[str, ...], str | None]


def parsed(text: str) -> list[Pattern]:
    """The patterns of a table: collections, and the label of the hierarchy above the last one or None."""
    out = []
    for line in text.strip().splitlines():
        steps, _, label = line.partition("+")
        out.append((tuple(steps.split()), label.strip() or None))
    return out


class Ids(NamedTuple):
    """Distinct vertices (id), how many there are, and a name that no others have."""

    name: object
    rows: DataFrame
    n: int


def _counted(name: object, rows: DataFrame) -> Ids:
    stored = step(rows, n=F.count(F.lit(1)))
    return Ids(name, stored, stored.measured["n"])


def _only(rows: DataFrame, end: str, ids: Ids | None, rest: Ids | None) -> DataFrame:
    """Rows whose end is among the ids; ``rest`` are those of their ends that aren't, None if there are none."""
    if rest is None:
        return rows
    if rest.n <= SENT:
        return rows.join(F.broadcast(rest.rows), rows[end] == rest.rows["id"], "left_anti")
    return rows.join(F.broadcast(ids.rows) if ids.n <= SENT else ids.rows.hint("shuffle_hash"), rows[end] == ids.rows["id"], "left_semi")


def pattern_members(edges: DataFrame, patterns: list[Pattern], repeated: bool = True) -> DataFrame:
    """(pattern, kind, id): the vertices and edges on paths of each pattern, and the vertices of the longest chains above their ends.

    ``repeated``: whether an edge may have several rows; without it, they aren't looked for.
    """
    for steps, _ in patterns:
        if len(steps) < 2 or len(set(steps)) < len(steps):
            raise ValueError(f"a pattern has two different collections at least: {' '.join(steps)}")
    with sparing(edges.sparkSession):
        return _members(edges, patterns, repeated)


def _members(edges: DataFrame, patterns: list[Pattern], repeated: bool) -> DataFrame:
    ways = sorted({" ".join(way) for steps, _ in patterns for x in zip(steps, steps[1:]) for way in (x, x[::-1])})
    walks = sorted({f"{steps[-1]}-{steps[-1]} {label}" for steps, label in patterns if label})
    hop = F.concat(terms.collection_of(F.col("src")), F.lit(" "), terms.collection_of(F.col("dst")))
    walk = F.when(F.size("labels") == 1, F.concat("collection", F.lit(" "), F.get("labels", F.lit(0))))
    found = edges.select(F.concat_ws("/", "collection", "key").alias("e"), F.col("src").alias("a"), F.col("dst").alias("b"), F.when(walk.isin(*walks), walk).alias("walk"), F.when(hop.isin(*ways), hop).alias("hop"))
    stored = step(found.where("hop IS NOT NULL OR walk IS NOT NULL"), "hop")
    back = F.concat(F.substring_index("hop", " ", -1), F.lit(" "), F.substring_index("hop", " ", 1))
    both = F.array(F.struct(F.col("a").alias("id"), F.col("hop").alias("way")), F.struct(F.col("b").alias("id"), back.alias("way")))
    ends = step(stored.where("hop IS NOT NULL").select(F.explode(both).alias("x")).select("x.id", "x.way").distinct(), "way")
    counts = {r["way"]: r["count"] for r in ends.groupBy("way").count().collect()}  # a row for each two neighbours in a pattern

    def at(x: str, y: str) -> Ids:
        """The vertices of a collection with an edge to another."""
        return Ids(f"{x} {y}", ends.where(F.col("way") == f"{x} {y}").select("id"), counts.get(f"{x} {y}", 0))

    def near(x: str, y: str) -> DataFrame:
        there = F.col("hop") == f"{x} {y}"
        end = lambda c, d: F.when(there, F.col(c)).otherwise(F.col(d)).alias(c)
        return stored.where(F.col("hop").isin(f"{x} {y}", f"{y} {x}")).select("e", end("a", "b"), end("b", "a"))

    beyond: dict[tuple[object, object], Ids | None] = {}

    def outside(x: str, y: str, ids: Ids | None) -> Ids | None:
        """Of the vertices of a collection with an edge to another those that aren't among the ids; None if all are."""
        all_ = at(x, y)
        if ids is None or ids.name == all_.name:
            return None
        key = (all_.name, ids.name)
        if key not in beyond:
            rest = _counted(key, all_.rows.join(F.broadcast(ids.rows) if ids.n <= SENT else ids.rows.hint("shuffle_hash"), "id", "left_anti"))
            if not rest.n:
                discard(rest.rows)
            beyond[key] = rest if rest.n else None
        return beyond[key]

    # forwards: of each prefix, the vertices that it reaches
    reached: dict[tuple[str, ...], Ids] = {}
    for steps, _ in patterns:
        for n in range(2, len(steps) + 1):
            if steps[:n] not in reached:
                (x, y), before = steps[n - 2 : n], reached.get(steps[: n - 1])
                rest = outside(x, y, before)
                reached[steps[:n]] = at(y, x) if rest is None else _counted(steps[:n], _only(near(x, y), "a", before, rest).select(F.col("b").alias("id")).distinct())
    # and back: of each end (what follows a prefix), the vertices of the prefix's last collection that go on to it
    out: list[DataFrame] = []
    crossed: dict[tuple[object, ...], tuple[DataFrame, list[str]]] = {}  # edges between two collections, and the patterns that have them all
    for steps, label in patterns:
        name = " ".join(steps) + (f" + {label}" if label else "")
        last, members = reached[steps], [reached[steps].rows]
        for n in range(len(steps) - 1, 0, -1):
            x, y = steps[n - 1 : n + 1]
            before = reached.get(steps[:n])
            under, over = outside(x, y, before), outside(y, x, last)
            rows = _only(_only(near(x, y), "a", before, under), "b", last, over)
            key = (frozenset((x, y)), under and under.name, over and over.name)
            crossed.setdefault(key, (rows, []))[1].append(name)
            if under is None and over is None:
                last = at(x, y)
            else:
                left = rows if over is not None else _only(at(x, y).rows.withColumnRenamed("id", "a"), "a", before, under)
                last = _counted((steps, n), left.select(F.col("a").alias("id")).distinct())
            members.append(last.rows)
        vertices = reduce(DataFrame.union, members)
        if label:
            up = stored.where(F.col("walk") == f"{steps[-1]}-{steps[-1]} {label}").select(F.col("a").alias("src"), F.col("b").alias("dst"))
            chains = longest_chains(up, reached[steps].rows)
            vertices = step(vertices.union(chains.select(F.explode("chain"))).distinct())
        out.append(vertices.select(F.lit(name).alias("pattern"), F.lit("vertex").alias("kind"), "id"))
    for rows, names in crossed.values():
        each = rows.select("e").distinct() if repeated else rows
        out.append(each.select(F.explode(F.array(*[F.lit(name) for name in names])), F.lit("edge"), "e"))
    return reduce(DataFrame.union, out)
