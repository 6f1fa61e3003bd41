"""Approximate nearest neighbours by balanced posting lists.

Centroids come from repeated halving of the largest cluster of a bounded sample, so lists are balanced; they and the
graph of their nearest neighbours have a bounded size and travel by broadcast. Every vector is put on the list of its
nearest centroid and, near a boundary, on those of other centroids that are almost as near; the graph is walked to find them. A query ranks all
centroids exactly, and takes the lists whose distance is within a ratio of the nearest one's, at least ``LEAST`` of them,
enough to fill its answer, and at most a fixed share of all lists, so that recall doesn't fall as lists become more. Lists are cut into parts of bounded size, so one list (many equal vectors) is spread
over tasks; each part gives a query its best candidates, with exact distances in double precision.

Defined cases: vectors that are null, of zero length, all zero, or hold null or non-finite components take no part, nor
do those with another number of components than most, or a null vec_id; equal distances go by vec_id; repeated rows
count once; fewer candidates than asked for are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.common import share

#: Vectors that the centroids are fitted on at most (about), vectors of a list aimed at, and lists at most.
SAMPLE = 20_000
LIST = 256
MAX_LISTS = 2048
#: Neighbours of a centroid in the graph, and centroids kept while walking it.
DEGREE, POOL = 16, 64
#: Lists of a vector at most, and how much farther than the nearest they may be.
COPIES, NEAR = 4, 1.10
#: Lists of a query at least, how much farther they may be, and vectors on them at least.
LEAST, REACH, FILL = 12, 1.5, 64
#: Lists of a query at most: the share of all lists, where that is more than the number.
MOST, SHARE = 40, 1 / 8
PART = 2048


@dataclass
class Index:
    centroids: np.ndarray
    graph: np.ndarray  # of each centroid, its nearest ones
    entries: np.ndarray  # centroids that walks start from


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as doubles, each vec_id once."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    found = embeddings.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(good)
    usual = found.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return found.where(F.size("v") == (usual["size"] if usual else 0)).dropDuplicates(["vec_id"])


def fit(sample: np.ndarray, lists: int) -> Index:
    """Balanced centroids by halving the largest cluster, and the graph over them."""
    rng = np.random.default_rng(5)
    parts = [np.arange(len(sample))]
    while len(parts) < lists:
        k = max(range(len(parts)), key=lambda i: len(parts[i]))
        if len(parts[k]) < 2:
            break
        rows = sample[parts[k]]
        axis = rows[rng.integers(len(rows))] - rows[rng.integers(len(rows))]
        for _ in range(6):  # the direction in which the cluster is widest
            centred = rows - rows.mean(0)
            axis = centred.T @ (centred @ (axis if axis.any() else rng.normal(size=rows.shape[1])))
            axis /= max(np.linalg.norm(axis), 1e-300)
        order = np.argsort(rows @ axis, kind="stable")
        half = len(order) // 2
        parts[k : k + 1] = [parts[k][order[:half]], parts[k][order[half:]]]
    centroids = np.array([sample[p].mean(0) for p in parts])
    for _ in range(4):
        owner = _nearest(sample, centroids, 1)[:, 0]
        size = np.bincount(owner, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, owner, sample)
        centroids = np.where((size > 0)[:, None], total / np.maximum(size, 1)[:, None], centroids)
    graph = _nearest(centroids, centroids, min(DEGREE + 1, len(centroids)))
    return Index(centroids, graph, rng.permutation(len(centroids))[: min(POOL // 2, len(centroids))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0))


def _nearest(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(a), k), np.int64)
    for i in range(0, len(a), 2048):
        d = _distances(a[i : i + 2048], b)
        out[i : i + 2048] = np.argsort(d, axis=1, kind="stable")[:, :k]
    return out


def walk(index: Index, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each vector: the centroids found nearest by best-first walks on the graph, nearest first, and their distances."""
    n, pool = len(vectors), min(POOL, len(index.centroids))
    norm = (index.centroids**2).sum(1)
    own = (vectors**2).sum(1)

    def measure(nodes: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(own[:, None] + norm[nodes] - 2 * np.einsum("nd,nkd->nk", vectors, index.centroids[nodes]), 0))

    nodes = np.broadcast_to(index.entries, (n, len(index.entries)))
    dist, seen = measure(nodes), np.zeros(nodes.shape, bool)
    for _ in range(2 * pool):
        next_ = np.where(seen, np.inf, dist)
        at = next_.argmin(1)
        if not np.isfinite(next_[np.arange(n), at]).any():
            break
        seen = seen.copy()
        seen[np.arange(n), at] = True
        new = index.graph[nodes[np.arange(n), at]]
        nodes = np.concatenate((nodes, new), 1)
        dist = np.concatenate((dist, measure(new)), 1)
        seen = np.concatenate((seen, np.zeros(new.shape, bool)), 1)
        # of equal nodes the one already walked from stays; then the nearest ones
        order = np.lexsort((~seen, nodes), axis=1)
        nodes, dist, seen = (np.take_along_axis(x, order, 1) for x in (nodes, dist, seen))
        dist = dist.copy()
        dist[:, 1:][nodes[:, 1:] == nodes[:, :-1]] = np.inf
        seen = seen | ~np.isfinite(dist)
        order = np.argsort(dist, axis=1, kind="stable")[:, :pool]
        nodes, dist, seen = (np.take_along_axis(x, order, 1) for x in (nodes, dist, seen))
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(dist, order, 1)


def probes(index: Index, filled: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, list): of each query, the lists it takes; ``filled`` has the number of vectors on each list."""
    lists = len(index.centroids)
    dist = _distances(vectors, index.centroids)
    nodes = np.argsort(dist, axis=1, kind="stable")
    dist = np.take_along_axis(dist, nodes, 1)
    before = np.cumsum(filled[nodes], 1) - filled[nodes]
    place = np.arange(lists)
    row, place = np.nonzero((place < LEAST) | (before < FILL) | (dist <= REACH * dist[:, :1]) & (place < max(MOST, SHARE * lists)))
    return row, nodes[row, place]


def search(embeddings: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): of each vector whose id is divisible by ``every``, its k nearest others found."""
    spark = embeddings.sparkSession
    vectors = usable(embeddings)
    total = vectors.count()
    sample = vectors.where(share(F.col("vec_id"), 53) < min(1.0, SAMPLE / max(total, 1))).select("v").toPandas()
    sample = np.array(sample["v"].tolist(), np.float64) if len(sample) else np.zeros((1, 1))
    lists = int(min(MAX_LISTS, max(1, total // LIST), max(1, len(sample) // 8)))
    shared = spark.sparkContext.broadcast(fit(sample, lists))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                v = part.column("v").flatten().to_numpy().reshape(part.num_rows, -1)
                nodes, dist = walk(shared.value, v)
                ok = (dist[:, :COPIES] <= NEAR * dist[:, :1]) & np.isfinite(dist[:, :COPIES])
                ok[:, 0] = True
                row, place = np.nonzero(ok)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[row, place]), part.column("vec_id").take(take), part.column("v").take(take)], ["list", "vec_id", "v"])

    posted = vectors.mapInArrow(post, "list long, vec_id long, v array<double>")
    # at most MAX_LISTS rows
    sizes = {r["list"]: r["count"] for r in posted.groupBy("list").count().collect()}
    size = np.array([sizes.get(i, 0) for i in range(lists)])
    parts = spark.sparkContext.broadcast(np.maximum(1, -(-size // PART)))
    filled = spark.sparkContext.broadcast(size)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                row, node = probes(shared.value, filled.value, some.column("v").flatten().to_numpy().reshape(some.num_rows, -1))
                many = parts.value[node]
                row, node = np.repeat(row, many), np.repeat(node, many)
                part = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(part), some.column("vec_id").take(take), some.column("v").take(take)], ["list", "part", "query_id", "q"])

    queries = vectors.where(F.col("vec_id") % every == 0).mapInArrow(choose, "list long, part long, query_id long, q array<double>")
    number = F.lit([int(x) for x in parts.value]) if lists else F.lit(None)
    posted = posted.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.element_at(number, F.col("list").cast("int") + 1).cast("long")))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            v, ids = np.array(right["v"].tolist()), right["vec_id"].to_numpy()
            for query, q in zip(left["query_id"], left["q"]):
                score = np.sqrt(((v - np.asarray(q)) ** 2).sum(1))
                best = np.lexsort((ids, score))
                best = best[ids[best] != query][:k]
                out.append((np.full(len(best), query), ids[best], score[best]))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    met = queries.groupBy("list", "part").cogroup(posted.groupBy("list", "part")).applyInPandas(compare, "query_id long, vec_id long, score double")
    best = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
