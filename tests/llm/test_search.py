"""Nearest neighbours against brute force in double precision."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwarden.llm import block_search as B


def brute(rows, k):
    usable = [
        (i, np.array(v, dtype=float))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, x in usable:
        if q % 10 == 0:
            scored = []
            for i, y in usable:
                if i != q and len(x) == len(y):
                    total = 0.0
                    for a, b in zip(x, y, strict=True):
                        total += (b - a) ** 2
                    scored.append((float(np.sqrt(total)), i))
            out[q] = sorted(scored)[:k]
    return {q: v for q, v in out.items() if v}


def vectors():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(50)]  # one vector, many rows
    rows += [(300, None), (310, []), (320, [0.0] * 6), (330, [1.0, None, 0, 0, 0, 0]), (340, [float("nan")] + [1.0] * 5)]
    rows += [(350, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (360, [1.0, 2.0]), (370, [1.5, 2.0]), (380, [1e-30] * 6)]
    return [(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in rows]


@pytest.mark.parametrize("tile", [16, 4096])
def test_search_is_exact(spark, monkeypatch, tile):
    monkeypatch.setattr(B, "TILE", tile)
    monkeypatch.setattr(B, "BLOCK", 8 if tile == 16 else 1024)
    monkeypatch.setattr(B, "MERGE", 2)
    rows = vectors()
    df = spark.createDataFrame(rows, "id long, v array<double>, rank int").repartition(3)
    got = {}
    for r in B.nearest(df, "id", "v", F.col("id") % 10 == 0, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert got == brute([(i, v) for i, v, _ in rows], 10)
    assert 370 not in {i for q, v in got.items() if q != 360 for _, i in v}


def test_no_vectors(spark):
    df = spark.createDataFrame([], "id long, v array<float>")
    assert B.nearest(df, "id", "v", F.col("id") % 10 == 0).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 1500))
    code, scale, error = B._quantised(x)
    assert np.allclose(np.sqrt(((x - code * scale[:, None]) ** 2).sum(axis=1)), error)
    assert (B._products(code, code) == code.astype(np.int64) @ code.astype(np.int64).T).all()
