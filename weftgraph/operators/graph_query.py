"""Questions to a property graph: reachability, subgraphs, ancestors and typed paths, as joins on frontiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions import terms
from weftgraph.plans.iterate import step

# fixed values: what walks leave out, and how each ontology is completed
IGNORED_VERTICES = ("CHEBI", "NCT")
IGNORED_EDGES = ("PR-NCBITaxon",)
HIERARCHY = {
    "CL": ("all", None),
    "GO": ("walk", "SUB_CLASS_OF"),
    "MONDO": ("walk", "SUB_CLASS_OF"),
    "HP": ("walk", "SUB_CLASS_OF"),
    "PATO": ("walk", "SUB_CLASS_OF"),
    "HsapDv": ("walk", "SUB_CLASS_OF"),
    "NCBITaxon": ("walk", "SUB_CLASS_OF"),
    "Orphanet": ("walk", "SUB_CLASS_OF"),
    "PR": ("none", "SUB_CLASS_OF"),
    "CHEBI": ("walk", "SUB_CLASS_OF"),
    "UBERON": ("walk", "PART_OF"),
}
MAX_DEPTH = 10


#: Collections whose names walks look at, at most; with more, hops read all edges.
NAMES = 1_000
#: Vertices that are sent to all executors at most; with more, they meet edges by shuffles.
SENT = 100_000


def adjacency(edges: DataFrame, ignored_vertices: tuple[str, ...] = IGNORED_VERTICES, ignored_edges: tuple[str, ...] = IGNORED_EDGES) -> DataFrame:
    """Neighbours (a, b) in both directions, over edges that walks may use, with their ``collection`` and whether they lead ``back``."""
    if not hasattr(edges, "step_path"):
        edges = step(edges)  # each hop reads them anew
    usable = edges.where(~terms.self_referential(F.col("collection")))
    if ignored_edges:
        usable = usable.where(~F.col("collection").isin(*ignored_edges))
    way = lambda a, b, back: usable.select(F.col(a).alias("a"), F.col(b).alias("b"), "collection", F.lit(back).alias("back"))
    both = way("src", "dst", False).union(way("dst", "src", True))
    if ignored_vertices:
        both = both.where(~terms.collection_of(F.col("b")).isin(*ignored_vertices))
    both.kinds = kinds(edges)
    return both


def kinds(edges: DataFrame) -> dict[str, tuple[str, str]] | None:
    """The collections of the two ends by edge collection, as its name ``A-B`` says; None if there are too many or an end is of another one."""
    if not hasattr(edges, "kinds"):
        side = lambda k: F.concat(F.substring_index("collection", "-", k), F.lit("/"))
        fits = F.coalesce(F.col("src").startswith(side(1)) & F.col("dst").startswith(side(-1)), F.lit(False))
        found = edges.groupBy("collection").agg(F.min(fits).alias("fits")).limit(NAMES + 1).collect()  # a row for each collection of edges
        named = len(found) <= NAMES and all(r["fits"] for r in found)
        edges.kinds = {r["collection"]: tuple(r["collection"].split("-", 1)) for r in found} if named else None
    return edges.kinds


def _counts(ids: DataFrame) -> dict[str | None, int] | None:
    """How many vertices (id) there are of each collection; None if the collections are too many."""
    found = ids.groupBy(terms.collection_of(F.col("id")).alias("c")).count().limit(NAMES + 1).collect()  # a row for each collection
    return None if len(found) > NAMES else {r["c"]: r["count"] for r in found}


def _meeting(edges: DataFrame, end: str, ids: DataFrame, n: int | None, how: str = "left_semi") -> DataFrame:
    """Edges whose end is among ``n`` distinct vertices (id), or isn't."""
    return edges.join(F.broadcast(ids) if n is not None and n <= SENT else ids.hint("shuffle_hash"), edges[end] == ids["id"], how)


def reach(near: DataFrame, sources: DataFrame, depth: int = MAX_DEPTH) -> DataFrame:
    """(id, depth): every vertex within ``depth`` steps of the sources (id), and how far; sources always.

    Each hop joins the last frontier only, with the edges of the collections that lead on from it, leaves out what was found in
    the collections that these lead to, and writes what it found. ``near`` is as made by ``adjacency``.
    """
    return _walk(near, sources.select("id"), depth)


def reach_each(near: DataFrame, sources: DataFrame, depth: int) -> DataFrame:
    """(source, id, depth): as ``reach``, for every source by itself."""
    return _walk(near, sources.select(F.col("id").alias("source"), "id"), depth)


def _walk(near: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    keys = starts.columns
    frontier = step(starts.distinct().withColumn("depth", F.lit(0)))
    tables = []
    for hop in range(depth + 1):
        counts = _counts(frontier)
        n = None if counts is None else sum(counts.values())
        if n == 0:
            break
        tables.append((frontier, counts))
        if hop == depth:
            break
        rows, targets = near, None
        if near.kinds is not None and counts is not None:
            forth, back = ({c: k[1 - p] for c, k in near.kinds.items() if k[p] in counts} for p in (0, 1))
            targets = {*forth.values(), *back.values()}
            rows = near.where(~F.col("back") & F.col("collection").isin(*forth) | F.col("back") & F.col("collection").isin(*back))
        if keys == ["id"]:
            found = _meeting(rows, "a", frontier, n)
        else:  # a vertex has a row for each source here
            found = rows.join(F.broadcast(frontier) if n is not None and n <= SENT else frontier, rows["a"] == frontier["id"])
        found = found.select(*keys[:-1], F.col("b").alias("id")).distinct()
        before = [t for t, c in tables if targets is None or c is None or c.keys() & targets]
        if before:
            found = found.join(reduce(DataFrame.union, before), keys, "left_anti")
        frontier = step(found.withColumn("depth", F.lit(hop + 1)))
    return reduce(DataFrame.union, [t for t, _ in tables] or [frontier])


def induced(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with both ends among the vertices (id), left-out collections included.

    Edges of collections without such ends are left out first. Of the others, the ends that aren't among the vertices are looked
    for; edges, which are wide, meet vertices only at ends of collections that have some, and meet what is outside if that is little.
    """
    if not hasattr(edges, "step_path"):
        edges = step(edges)
    counts, of = _counts(ids), kinds(edges)
    if counts is None or of is None:
        return _meeting(_meeting(edges, "src", ids, None), "dst", ids, None)
    of = {c: k for c, k in of.items() if k[0] in counts and k[1] in counts}
    edges = edges.where(F.col("collection").isin(*of))
    if sum(counts.values()) <= SENT:
        return _meeting(_meeting(edges, "src", ids, 0), "dst", ids, 0)
    outside = step(edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct().join(ids, "id", "left_anti"))
    beyond = _counts(outside)
    if beyond is None:
        return _meeting(_meeting(edges, "src", ids, None), "dst", ids, None)
    n = sum(beyond.values())
    for end, side in (("dst", 1), ("src", 0)):
        touched = [c for c, k in of.items() if k[side] in beyond]
        if touched:
            ends = outside.where(terms.collection_of(F.col("id")).isin(*{of[c][side] for c in touched}))
            within = F.col("collection").isin(*touched)
            edges = edges.where(~within).unionByName(_meeting(edges.where(within), end, ends, n, "left_anti"))
    return edges


def ids_of(vertices: DataFrame, collection: str | None = None) -> DataFrame:
    found = vertices if collection is None else vertices.where(F.col("collection") == collection)
    return found.select(F.concat_ws("/", "collection", "key").alias("id"))


def find(vertices: DataFrame, edges: DataFrame, collection: str, depth: int = MAX_DEPTH, **ignored: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The subgraph around a collection: vertices (id, depth) within reach and the edges among them."""
    found = reach(adjacency(edges, **ignored), ids_of(vertices, collection), depth)
    return found, induced(edges, found)


def hierarchy_edges(edges: DataFrame, rules: dict[str, tuple[str, str | None]] = HIERARCHY) -> DataFrame:
    """Edges that ancestor walks may take: of ``X-X``, with the one label of X's rule."""
    walks = [(f"{k}-{k}", label) for k, (how, label) in rules.items() if how == "walk"]
    if not walks:
        return edges.limit(0)
    wanted = F.create_map(*[F.lit(x) for pair in walks for x in pair])
    return edges.where((F.size("labels") == 1) & (F.get("labels", F.lit(0)) == wanted[F.col("collection")]))


def ancestors(edges: DataFrame, starts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All vertices (id) above the starts (id), starts included, and the hierarchy edges met on the way."""
    up = step(edges)
    near = up.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    frontier = step(starts.select("id").distinct())
    visited = frontier
    while True:
        found = frontier.join(near, frontier["id"] == near["a"]).select(F.col("b").alias("id")).distinct()
        frontier = step(found.join(visited, "id", "left_anti"))
        if frontier.isEmpty():
            return visited, up.join(visited, up["src"] == visited["id"], "left_semi")
        visited = visited.union(frontier)


def enrich(vertices: DataFrame, edges: DataFrame, found: DataFrame, among: DataFrame, rules: dict[str, tuple[str, str | None]] = HIERARCHY) -> tuple[DataFrame, DataFrame]:
    """Completes a subgraph (ids, edges) by its ontologies: whole ones, or the ancestors of what it holds."""
    ids = step(found.select("id").distinct())
    prefix = terms.collection_of(F.col("id"))
    present = [r[0] for r in ids.select(prefix).where(prefix.isin(*rules)).distinct().collect()]  # at most one row a rule
    whole = [k for k in present if rules[k][0] == "all"]
    walked = {k: rules[k] for k in present if rules[k][0] == "walk"}
    more_ids, more_edges = ids, among
    if whole:
        more_ids = more_ids.union(ids_of(vertices.where(F.col("collection").isin(*whole))))
        more_edges = more_edges.unionByName(edges.where(F.col("collection").isin(*[f"{k}-{k}" for k in whole])))
    if walked:
        above, met = ancestors(hierarchy_edges(edges, walked), ids.where(prefix.isin(*walked)))
        more_ids, more_edges = more_ids.union(above), more_edges.unionByName(met)
    return more_ids.distinct(), more_edges.dropDuplicates(["collection", "key"])


def typed_paths(edges: DataFrame, start: str, steps: tuple[str, ...]) -> DataFrame:
    """(vertices, edges): paths in any direction from a collection through the given ones; no edge twice."""
    both = edges.select(F.concat_ws("/", "collection", "key").alias("e"), F.col("src").alias("a"), F.col("dst").alias("b"))
    both = both.union(both.select("e", F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.withColumns({"ca": terms.collection_of(F.col("a")), "cb": terms.collection_of(F.col("b"))})
    paths = None
    for before, after in zip((start, *steps), steps):
        hop = both.where((F.col("ca") == before) & (F.col("cb") == after)).select("e", "a", "b")
        if paths is None:
            paths = hop.select(F.array("a", "b").alias("vertices"), F.array("e").alias("edges"), F.col("b").alias("at"))
        else:
            on = (paths["at"] == hop["a"]) & ~F.array_contains(paths["edges"], hop["e"])
            paths = paths.join(hop, on).select(F.array_append("vertices", F.col("b")).alias("vertices"), F.array_append("edges", F.col("e")).alias("edges"), F.col("b").alias("at"))
    return paths.select("vertices", "edges")


def path_members(edges: DataFrame, start: str, steps: tuple[str, ...]) -> DataFrame:
    """(position, id): the vertices that stand on some typed path, by semi-joins forwards and back, without path rows.

    For patterns that never cross one edge twice (no A, B, A in a row).
    """
    both = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = step(both.withColumns({"ca": terms.collection_of(F.col("a")), "cb": terms.collection_of(F.col("b"))}))
    hops = [both.where((F.col("ca") == x) & (F.col("cb") == y)).select("a", "b") for x, y in zip((start, *steps), steps)]
    for k in range(1, len(hops)):  # forwards: hops that continue an earlier one
        hops[k] = step(hops[k].join(hops[k - 1].select(F.col("b").alias("a")).distinct(), "a", "left_semi"))
    for k in reversed(range(len(hops) - 1)):  # back: hops that lead on
        hops[k] = step(hops[k].join(hops[k + 1].select(F.col("a").alias("b")).distinct(), "b", "left_semi"))
    out = hops[0].select(F.lit(0).alias("position"), F.col("a").alias("id"))
    for k, hop in enumerate(hops):
        out = out.union(hop.select(F.lit(k + 1), "b"))
    return out.distinct()


def longest_chains(edges: DataFrame, starts: DataFrame, most: int = 64) -> DataFrame:
    """(start, chain): of each start (id), its longest outbound chain of at most ``most`` edges; ties by the smallest ids.

    Chains grow downwards from what has nothing above it: a round makes those of one length more, so each is made from the
    one below it in length and starts share them. Hierarchies that are higher than ``most`` or have cycles are walked from
    every start; they are taken to be without cycles: of chains that end in one vertex one goes on, and on a cycle it may be
    one that another's extension would not have blocked.
    """
    near = step(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct())
    below = near.select("a").distinct()
    tops = near.select(F.col("b").alias("id")).distinct().join(below, F.col("id") == F.col("a"), "left_anti")
    level = step(tops.select("id", F.array("id").alias("chain"), F.lit(0).alias("n")))
    levels, made, n = [], 0, level.count()
    for k in range(1, most + 2):
        above = level.select(F.col("id").alias("b"), "chain")
        grown = near.join(F.broadcast(above) if n <= SENT else above, "b").groupBy(F.col("a").alias("id"))
        level = step(grown.agg(F.min("chain").alias("above")).select("id", F.concat(F.array("id"), "above").alias("chain"), F.lit(k).alias("n")))
        n = level.count()
        if n == 0:
            break
        levels.append(level)
        made += n
    starts = starts.select("id").where("id IS NOT NULL").distinct()
    reached = reduce(DataFrame.union, levels) if levels else level
    wanted = below.count()
    several = made > wanted  # some vertices are reached over ways of different lengths, or a cycle leads to a top
    if n > 0 or (reached.select("id").distinct().count() if several else made) < wanted:
        return _chains_by_walks(near, starts, most)
    longest = reached.groupBy("id").agg(F.max_by("chain", "n").alias("chain")) if several else reached.select("id", "chain")
    return starts.join(longest, "id", "left").select(F.col("id").alias("start"), F.coalesce("chain", F.array("id")).alias("chain"))


def _chains_by_walks(near: DataFrame, starts: DataFrame, most: int) -> DataFrame:
    """As ``longest_chains``, by walks from every start; ``near`` (a, b) is stored."""
    frontier = step(starts.select(F.col("id").alias("start"), F.array("id").alias("chain"), F.col("id").alias("at")))
    best = frontier.select("start", "chain")
    for _ in range(most):
        grown = frontier.join(near, frontier["at"] == near["a"]).where(~F.array_contains("chain", F.col("b")))
        # of the chains of one start that end in one vertex the smallest goes on
        grown = grown.select("start", F.array_append("chain", F.col("b")).alias("chain"), F.col("b").alias("at"))
        frontier = step(grown.groupBy("start", "at").agg(F.min("chain").alias("chain")))
        if frontier.isEmpty():
            break
        best = best.union(frontier.select("start", "chain"))
    longest = F.max(F.size("chain"))
    size = best.groupBy("start").agg(longest.alias("size"))
    return best.join(size, "start").where(F.size("chain") == F.col("size")).groupBy("start").agg(F.min("chain").alias("chain"))


def paths_with_chains(edges: DataFrame, start: str, steps: tuple[str, ...], position: int, label: str, most: int = 64) -> DataFrame:
    """(vertices, edges, chain): typed paths, each with the longest chain of one label above its vertex at ``position``.

    The chain starts with that vertex; paths whose vertex has nothing above it get a chain of it alone.
    """
    paths = typed_paths(edges, start, steps).withColumn("_at", F.get("vertices", F.lit(position)))
    collection = steps[position - 1]
    up = hierarchy_edges(edges, {collection: ("walk", label)})
    chains = longest_chains(up, paths.select(F.col("_at").alias("id")).distinct(), most)
    return paths.join(chains.withColumnRenamed("start", "_at"), "_at", "left").select("vertices", "edges", F.coalesce("chain", F.array("_at")).alias("chain"))


def path_set(edges: DataFrame, start: str, patterns: list[tuple[tuple[str, ...], str | None]]) -> DataFrame:
    """(pattern, vertices, edges, chain): the paths of all patterns (collections, label of the chain above the last one, or None).

    Patterns are walked together: every prefix that several share is joined once and written.
    """
    both = edges.select(F.concat_ws("/", "collection", "key").alias("e"), F.col("src").alias("a"), F.col("dst").alias("b"))
    both = both.union(both.select("e", F.col("b").alias("a"), F.col("a").alias("b")))
    both = step(both.withColumns({"ca": terms.collection_of(F.col("a")), "cb": terms.collection_of(F.col("b"))}))
    prefixes: dict[tuple[str, ...], DataFrame] = {}

    def walked(steps: tuple[str, ...]) -> DataFrame:
        if steps not in prefixes:
            hop = both.where((F.col("ca") == (start, *steps)[-2]) & (F.col("cb") == steps[-1])).select("e", "a", "b")
            if len(steps) == 1:
                found = hop.select(F.array("a", "b").alias("vertices"), F.array("e").alias("edges"), F.col("b").alias("at"))
            else:
                before = walked(steps[:-1])
                on = (before["at"] == hop["a"]) & ~F.array_contains(before["edges"], hop["e"])
                found = before.join(hop, on).select(F.array_append("vertices", F.col("b")).alias("vertices"), F.array_append("edges", F.col("e")).alias("edges"), F.col("b").alias("at"))
            shared = sum(p[: len(steps)] == steps for p, _ in patterns) > 1
            prefixes[steps] = step(found) if shared else found
        return prefixes[steps]

    out = None
    for steps, label in patterns:
        found = walked(steps)
        if label is None:
            made = found.withColumn("chain", F.lit(None).cast("array<string>"))
        else:
            up = hierarchy_edges(edges, {steps[-1]: ("walk", label)})
            chains = longest_chains(up, found.select(F.col("at").alias("id")).distinct())
            made = found.join(chains.withColumnRenamed("start", "at"), "at", "left").withColumn("chain", F.coalesce("chain", F.array("at")))
        made = made.select(F.lit(" ".join((start, *steps))).alias("pattern"), "vertices", "edges", "chain")
        out = made if out is None else out.unionByName(made)
    return out


def members(paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct vertices (id) and edges (id) of paths and their chains."""
    vertices = paths.select(F.explode(F.concat("vertices", F.coalesce("chain", F.array().cast("array<string>")))).alias("id")).distinct()
    return vertices, paths.select(F.explode("edges").alias("id")).distinct()


def build_subgraph(vertices: DataFrame, edges: DataFrame, collection: str, rules: dict[str, tuple[str, str | None]] = HIERARCHY, depth: int = MAX_DEPTH, **ignored: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The whole job: vertices and edges around a collection, completed by their ontologies, with all their columns."""
    ids, among = enrich(vertices, edges, *find(vertices, edges, collection, depth, **ignored), rules)
    kept = vertices.withColumn("_id", F.concat_ws("/", "collection", "key")).join(ids.withColumnRenamed("id", "_id"), "_id", "left_semi").drop("_id")
    return kept, among
