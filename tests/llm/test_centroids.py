"""Centroid clustering against plain Python, with left-out vectors, ties, repeats and clashing columns."""

import hashlib
import math
import random

import numpy as np

from weftgraph.llm import centroids

COLUMNS = "vec_id long, embedding array<float>, cluster int, v string, norm double"


def brute(rows, k, size, rounds):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e in rows if e is not None and len(e) == size and all(x is not None and math.isfinite(x) for x in e)]
    middle = [v for _, v in sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in whole if i is not None)][:k]
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middle)) for _, v in whole]
        if turn < rounds:
            for j in range(len(middle)):
                own = [v for (_, v), (_, g) in zip(whole, near) if g == j]
                if own:
                    middle[j] = [sum(x) // len(own) for x in zip(*own)]
    total = sum(d for d, _ in near)
    inner = {j: sum(d for d, g in near if g == j) for j in range(len(middle))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, j, d, inner[j], total, digest[j]) for (i, _), (d, j) in zip(whole, near)), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 5, "x", 0.5) for i, e in rows], COLUMNS).repartition(3)


def found(spark, rows, k, size, rounds=5):
    return sorted((tuple(r) for r in centroids.cluster(frame(spark, rows), k, size, rounds).collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i % 7, 0.3) if k % 2 else rng.choice((0.0, 0.5)) for k in range(8)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(80)]  # copies: ties, and first centroids that stay without vectors
    rows += [(7, rows[9][1]), (7, rows[9][1]), (None, rows[3][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 7), (2003, [1.0] * 7 + [None]), (2004, [1.0] * 7 + [float("nan")]), (2005, [float("inf")] + [1.0] * 7)]
    assert found(spark, rows, 40, 8) == brute(rows, 40, 8, 5)
    assert found(spark, rows, 6, 8, 1) == brute(rows, 6, 8, 1)


def test_few_and_no_vectors(spark):
    rows = [(3, [0.1, -0.1]), (9, [0.1, -0.1]), (5, [-2.0, 7.0])]
    assert found(spark, rows, 40, 2) == brute(rows, 40, 2, 5)
    assert found(spark, [], 40, 2) == [] == found(spark, [(1, None), (None, [1.0, 2.0])], 40, 2)
    assert centroids.cluster(frame(spark, []), 40, 2).columns == centroids.cluster(frame(spark, rows), 40, 2).columns


def test_large_components_are_held_at_the_bound(spark):
    far = 256 * 65536
    got = found(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.0])], 2, 2, 1)
    assert all(d <= (2 * far) ** 2 for _, _, d, *_ in got) and len(got) == 3


def test_only_changed_components_are_multiplied(spark):
    """The matrix after an update equals the products with the new centroids."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(50)]
    vectors = centroids.integers(frame(spark, rows), 4)
    old = rng.integers(-200, 200, (3, 4))
    new = old.copy()
    new[1, 2] += 17
    state = centroids.assigned(centroids.assigned(vectors, None, old), old, new)
    for r in state.collect():
        assert r["dots"] == (new @ np.array(r["v"])).tolist() and r["distance"] == min(((new - np.array(r["v"])) ** 2).sum(1))
