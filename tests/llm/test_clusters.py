"""Clusters over approximations against a plain loop over all vectors and centroids."""

import hashlib
import math
import random

import numpy as np
import pytest

from tillwarden.llm import cell_clusters as C


def brute(rows, k, rounds, dim, scale):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(max(min(x * scale, C.LIMIT), -C.LIMIT)) for x in v]))

    def rank(row):
        return (row[0] is None, hashlib.sha256(f"1:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centroids = [v for _, v in sorted(kept, key=rank)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, own in groups.items():
            centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize(("dim", "k", "rounds"), [(5, 4, 3), (8, 7, 1), (3, 400, 2)])
def test_clusters_equal_a_plain_loop(spark, dim, k, rounds):
    rng = random.Random(dim)
    rows = [(i, [rng.gauss(i % 3, 0.4) for _ in range(dim)]) for i in range(200)]
    rows += [(300 + i, [0.5] * dim) for i in range(60)]  # one vector, many rows
    rows += [(7, [0.25] * dim), (7, [-0.25] * dim), (7, [0.25] * dim), (None, [0.1] * dim), (None, [0.3] * dim)]
    rows += [(400, None), (401, []), (402, [1.0] * (dim + 1)), (403, [None] + [1.0] * (dim - 1))]
    rows += [(404, [math.inf] + [1.0] * (dim - 1)), (405, [math.nan] * dim), (406, [1e30] * dim), (407, [-1e300] * dim)]
    clash = [(i, v, 9, "x") for i, v in rows]
    df = spark.createDataFrame(clash, "vec_id long, embedding array<double>, cluster int, cells string").repartition(3)
    got = C.clustered(df, "vec_id", "embedding", k, rounds, dim, 64)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert order(map(tuple, got.collect())) == order(brute(rows, k, rounds, dim, 64))


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    assert C.clustered(df, "vec_id", "embedding").collect() == []


def test_intervals_hold_the_distances_and_spare_most_fetches():
    rng = np.random.default_rng(3)
    centres = rng.integers(-200, 200, (8, 20))
    x = centres[rng.integers(0, 8, 3000)] + rng.integers(-15, 16, (3000, 20))
    cells = C.Cells.fitted(x[:500], x.min(axis=0), x.max(axis=0))
    packed = cells.packed(x)
    low, high = cells.tables(centres)
    exact = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    lows = sum(low[j, packed[:, j]] for j in range(packed.shape[1]))
    highs = sum(high[j, packed[:, j]] for j in range(packed.shape[1]))
    assert (lows <= exact).all() and (exact <= highs).all()
    cluster, fetched = C.Assigner(cells, centres).nearest(packed, x)
    assert (cluster == exact.argmin(axis=1)).all()
    assert fetched < 300
