"""Centroid clustering of integer vectors over a VA-file of few-bit cells.

Every component x becomes the integer floor(scale * x).  A vector's approximation is one cell of CELL_BITS bits
for each dimension, two to a byte; cells lie between borders of their own in each dimension.  For a set of centroids, lookup
tables hold the least and the greatest squared difference between a centroid's component and any value of a
cell, so that the sums over a vector's bytes are an interval for its squared distance to every centroid:

    low(centroid, cells)  <=  |x - centroid|^2  <=  high(centroid, cells)

Centroids whose low end is above the least high end are out.  Where one is left, the vector is assigned by its cells alone;
where intervals overlap (equal ends do, because of ties), its full components are fetched and compared with
the centroids left.  All of it is integer arithmetic, so results are exact and do not depend on the partitioning.

The table of approximations and vectors is written once.  A round is one scan of it without a shuffle: a task
returns, per cluster, a count and one sum per dimension, and only these meet.  The sums that
move a centroid need the components of all its vectors, hence a round reads both columns; distances are worked out
only for overlaps, and in the end for the one centroid of each vector.

Borders are inner quantiles of a bounded sample (the SAMPLE vectors of least hash) and the exact least and greatest value of
each dimension; any borders give the same clusters.  The driver holds the sample, the centroids and the sums.

Cases: vectors that are null, of another dimension, or hold a null or a component that is not finite take no part; a component
beyond 2**21 counts as 2**21 (so that squared distances fit 64 bits); a null id is
clustered like any other and comes last among the seeds; repeated ids are separate vectors, the smaller
one first where the order of seeds needs it; with fewer vectors than centroids every vector is a seed; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwarden.llm.shared import written

CELL_BITS = 4  # two cells to a byte
CELLS = 1 << CELL_BITS
SAMPLE = 4096  # vectors that the inner borders are taken from
LIMIT = 1 << 27  # integers beyond it count as this


def _integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, kept within LIMIT."""
    return F.transform(
        vector,
        lambda x: F.floor(F.greatest(F.least(x * F.lit(float(scale)), F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"),
    )


def _usable(vector: Column, dim: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == dim) & finite


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Integers of an array<int> column of ``dim`` components, without a copy."""
    return np.asarray(column.flatten()).reshape(-1, dim)


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """Bytes of a binary column whose values all have ``width`` bytes."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, dtype=np.uint8).reshape(-1, width)


@dataclass(frozen=True)
class Cells:
    """Borders of the cells: ``borders[d]`` has CELLS + 1 ascending integers; a cell holds both its ends."""

    borders: np.ndarray

    @classmethod
    def fitted(cls, sample: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> Cells:
        at = np.linspace(0, 1, CELLS + 1)[1:-1]
        inner = np.quantile(sample, at, axis=0, method="lower").T
        inner = np.clip(inner, least[:, None], greatest[:, None])
        return cls(np.concatenate([least[:, None], inner, greatest[:, None]], axis=1).astype(np.int64))

    def packed(self, x: np.ndarray) -> np.ndarray:
        """Cells of the rows of a matrix, dimensions 2j and 2j + 1 in byte j."""
        dim = x.shape[1]
        cells = np.zeros((len(x), dim + dim % 2), dtype=np.uint8)
        for d in range(dim):
            cells[:, d] = np.searchsorted(self.borders[d, 1:-1], x[:, d], side="left")
        return cells[:, ::2] << CELL_BITS | cells[:, 1::2]

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared difference: [byte of the approximation, its value, centroid]."""
        dim = len(self.borders)
        below = self.borders[:, None, :-1] - centroids.T[:, :, None]  # [dimension, centroid, cell]
        above = centroids.T[:, :, None] - self.borders[:, None, 1:]
        low = np.maximum(np.maximum(below, above), 0) ** 2
        high = np.maximum(np.abs(below), np.abs(above)) ** 2
        if dim % 2:
            low, high = (np.concatenate([t, np.zeros((1, *t.shape[1:]), dtype=np.int64)]) for t in (low, high))

        def joined(t: np.ndarray) -> np.ndarray:
            first, second = t[::2].transpose(0, 2, 1), t[1::2].transpose(0, 2, 1)  # [byte, cell, centroid]
            both = first[:, :, None, :] + second[:, None, :, :]
            return both.reshape(len(first), CELLS * CELLS, -1)

        return joined(low), joined(high)


class Assigner:
    """Nearest centroid of many vectors: by cells, and by components where intervals overlap."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        self.centroids = centroids
        self.low, self.high = cells.tables(centroids)

    def nearest(self, packed: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, int]:
        """Cluster of each row, and how many rows had their components fetched."""
        low = np.zeros((len(packed), len(self.centroids)), dtype=np.int64)
        high = np.zeros_like(low)
        for j in range(packed.shape[1]):
            low += self.low[j, packed[:, j]]
            high += self.high[j, packed[:, j]]
        left = low <= high.min(axis=1)[:, None]
        cluster = left.argmax(axis=1)
        overlap = np.flatnonzero(left.sum(axis=1) > 1)
        if len(overlap):
            fetched = vectors[overlap].astype(np.int64)
            exact = np.full((len(overlap), len(self.centroids)), np.iinfo(np.int64).max)
            for c in np.flatnonzero(left[overlap].any(axis=0)):
                rows = np.flatnonzero(left[overlap, c])
                exact[rows, c] = ((fetched[rows] - self.centroids[c]) ** 2).sum(axis=1)
            cluster[overlap] = exact.argmin(axis=1)  # the first of equal ones
        return cluster, len(overlap)


def _bounds(table: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each dimension: two rows a batch meet."""

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.stack([m.min(axis=0), m.max(axis=0)]) for b in batches if len(m := _matrix(b.column(0), dim))]
        if found:
            least, greatest = np.min([f[0] for f in found], axis=0), np.max([f[1] for f in found], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(least), pa.array(greatest)], ["d", "least", "greatest"])

    rows = table.select("vector").mapInArrow(extremes, "d int, least int, greatest int")
    got = rows.groupBy("d").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest")).orderBy("d").collect()
    return np.array([r.least for r in got], dtype=np.int64), np.array([r.greatest for r in got], dtype=np.int64)


def _moved(table: DataFrame, cells: Cells, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the exact floor of each cluster's mean; an empty cluster keeps its own."""
    k, dim = centroids.shape
    width = dim - dim // 2

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(cells, centroids)
        total, count = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(1), dim)
            if not len(vectors):
                continue
            cluster, _ = assigner.nearest(_bytes(batch.column(0), width), vectors)
            for c in np.unique(cluster):
                own = vectors[cluster == c]
                total[c] += own.sum(axis=0, dtype=np.int64)
                count[c] += len(own)
        used = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * dim), pa.array(total[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]), lists], ["c", "n", "total"])

    partial = table.select("cells", "vector").mapInArrow(sums, "c int, n long, total array<long>")
    each = partial.select("c", "n", F.posexplode("total").alias("d", "part"))
    met = each.groupBy("c", "d").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for row in met.collect():  # k * dim rows
        moved[row.c, row.d] = int(row.total) // row.n
    return moved


def clustered(
    vectors: DataFrame, id_column: str, vector_column: str, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector that takes part.

    Seeds are the k vectors of least SHA-256 of ``1:<id>``.  ``rounds`` times all vectors are assigned to the
    nearest centroid (of equal ones the first) and centroids moved; then vectors are assigned once more.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")
    ).filter(_usable(F.col("v"), dim))
    table = written(rows.select("vec_id", _integers(F.col("v"), scale).alias("vector")), "cluster-vectors")
    hashed = table.withColumn("h", F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))
    first = hashed.orderBy(F.col("h").asc_nulls_last(), "vector").limit(max(k, SAMPLE)).select("vector").collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    sample = np.array([r.vector for r in first], dtype=np.int64)
    cells = Cells.fitted(sample, *_bounds(table, dim))
    centroids = sample[:k]

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = cells.packed(_matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p.tobytes() for p in packed], pa.binary()), batch.column(1)],
                ["vec_id", "cells", "vector"],
            )

    filed = table.mapInArrow(approximate, "vec_id long, cells binary, vector array<int>")
    filed = written(filed, "cluster-cells")
    for _ in range(rounds):
        centroids = _moved(filed, cells, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(cells, centroids)
        for batch in batches:
            own = _matrix(batch.column(2), dim)
            cluster, _ = assigner.nearest(_bytes(batch.column(1), dim - dim // 2), own)
            distance = ((own - centroids[cluster]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance.astype(np.int64))],
                ["vec_id", "cluster", "distance"],
            )

    assigned = written(filed.mapInArrow(assign, "vec_id long, cluster int, distance long"), "cluster-assigned")
    # one row a cluster, so at most k
    digests = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "c int, centroid_sha256 string")
    totals = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    every = F.sum("own").over(Window.partitionBy()).cast("long")
    figures = totals.join(F.broadcast(named), F.col("cluster") == F.col("c")).select(
        "c", F.col("own").cast("long").alias("cluster_inertia"), every.alias("inertia"), "centroid_sha256"
    )
    return assigned.join(F.broadcast(figures), F.col("cluster") == F.col("c")).drop("c")
