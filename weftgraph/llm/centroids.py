"""Centroid clustering on an incremental distance matrix of exact integers.

Vectors become integers (``floor(256 * x)``), and each carries its dot products with all centroids in a table that every
round writes anew. When centroids move, a vector's product with one of them changes by the vector's components times the
changes of that centroid, so only components that changed are multiplied; then the nearest centroid is found from
``|v|^2 - 2 v.c + |c|^2``. What the driver holds is the centroids: ``k`` times ``size`` numbers, whatever the input.

Defined cases: vectors that are null, of another length, or hold null or non-finite components are left out; a null
vec_id is clustered but is never a first centroid; with fewer than ``k`` vectors with an id there are as many centroids
as those, and none without any (then the result is empty); repeated vec_ids keep all their rows, and where their hashes
tie, the smaller vector comes first; equal distances go to the smaller number; integers beyond 2^24 either way (components
beyond 65,536) are held at that bound, so that distances fit a long, and an inertia that doesn't is null; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import discard, materialise

SCALE = 256
BOUND = 1 << 24
#: Vectors that are worked on at a time; the matrix of their products is this times the number of centroids.
ROWS = 4096
STATE = "vec_id long, v array<int>, norm long, dots array<long>, cluster int, distance long"


def integers(vectors: DataFrame, size: int) -> DataFrame:
    """(vec_id, v, norm): kept vectors of (vec_id, embedding) as integers, with the sum of their squares."""
    usable = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    whole = lambda x: F.floor(F.greatest(F.least(SCALE * x.cast("double"), F.lit(float(BOUND))), F.lit(-float(BOUND)))).cast("int")
    kept = vectors.select("vec_id", "embedding").where((F.size("embedding") == size) & F.forall("embedding", usable))
    made = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v"))
    return made.withColumn("norm", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x.cast("long")))


def first_centroids(vectors: DataFrame, k: int, size: int, seed: str) -> np.ndarray:
    """The ``k`` vectors whose ``seed:vec_id`` has the smallest SHA-256, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.where("vec_id is not null").select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([row["v"] for row in rows], np.int64).reshape(-1, size)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def assigned(state: DataFrame, old: np.ndarray | None, new: np.ndarray) -> DataFrame:
    """The state after centroids moved from ``old`` to ``new``; without ``old``, the state starts from vectors alone."""
    k, size = new.shape
    change = new if old is None else new - old
    moved = [np.flatnonzero(row) for row in change]
    length = (new * new).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                v, norm = _matrix(batch.column("v"), size), batch.column("norm").to_numpy()
                dots = np.zeros((len(v), k), np.int64) if old is None else _matrix(batch.column("dots"), k)
                for j, where in enumerate(moved):
                    if len(where):
                        dots[:, j] += v[:, where] @ change[j, where]
                far = norm[:, None] - 2 * dots + length
                cluster = far.argmin(1)  # the first of equal ones
                distance = far[np.arange(len(v)), cluster]
                columns = [batch.column("vec_id"), _lists(v, pa.int32()), pa.array(norm), _lists(dots, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "norm", "dots", "cluster", "distance"])

    return state.mapInArrow(run, STATE)


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids at the exact floor of the mean of their vectors; those without vectors stay."""
    size = centroids.shape[1]
    sums: list[Column] = [F.sum(F.get("v", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(size)]
    out = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(size)]
    return out


def cluster(vectors: DataFrame, k: int = 40, size: int = 64, rounds: int = 5, seed: str = "2") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector of (vec_id, embedding)."""
    spark = vectors.sparkSession
    vectors = integers(vectors, size)
    centroids = first_centroids(vectors, k, size, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    state = materialise(assigned(vectors, None, centroids))
    for _ in range(rounds):
        new = moved(state, centroids)
        after = materialise(assigned(state, centroids, new))
        discard(state)
        state, centroids = after, new
    inertia = {row["cluster"]: row["d"] for row in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    fits = lambda x: int(x) if x < 1 << 63 else None
    digest = lambda row: hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()
    # a row for each centroid, k at most
    facts = spark.createDataFrame([(j, fits(d), fits(sum(inertia.values())), digest(centroids[j])) for j, d in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 40, size: int = 64, rounds: int = 5, seed: str = "2") -> str:
    """DuckDB SQL for ``cluster``."""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: isfinite(x))) = {size})""",
        "x AS MATERIALIZED (SELECT r, unnest(range(len(c))) AS i, unnest(c) AS x FROM v)",
        f"""c0 AS MATERIALIZED (
  SELECT k, unnest(range(len(c))) AS i, unnest(c) AS x
  FROM (SELECT row_number() OVER (ORDER BY sha256(concat('{seed}:', vec_id)), c) - 1 AS k, c FROM v WHERE vec_id IS NOT NULL) WHERE k < {k})""",
    ]
    for j in range(rounds + 1):
        parts.append(
            f"""a{j} AS MATERIALIZED (
  SELECT r, arg_min(k, d * {k} + k) AS k, min(d) AS d
  FROM (SELECT x.r, c{j}.k, CAST(sum((x.x - c{j}.x) * (x.x - c{j}.x)) AS BIGINT) AS d FROM x JOIN c{j} USING (i) GROUP BY ALL) GROUP BY r)"""
        )
        if j < rounds:
            parts.append(
                f"""c{j + 1} AS MATERIALIZED (
  SELECT k, i, CAST((s - ((s % n + n) % n)) // n AS BIGINT) AS x FROM (SELECT k, i, sum(x) AS s, count(*) AS n FROM a{j} JOIN x USING (r) GROUP BY ALL)
  UNION ALL SELECT k, i, x FROM c{j} WHERE k NOT IN (SELECT k FROM a{j}))"""
            )
    last = rounds
    return f"""
WITH {", ".join(parts)},
named AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN v USING (r) JOIN named USING (k)"""
