"""Exact nearest neighbours of a query set by a block matrix join over int8 tiles.

Vectors are dealt into tiles of candidates and blocks of queries; a tile and a block meet once, so a
task holds one tile, one block and their distances, however many vectors there are.  Each
vector x is kept as a scale s and int8 codes q, with its exact quantisation error e = |x - s q|.
A tile's int8 products give d' = |s q - s' q'| for every pair of a tile and a block, and

    d' - e - e'  <=  |x - y|  <=  d' + e + e'.

A candidate survives for a query if its lower bound does not exceed the k-th least upper bound in the
tile.  Survivors are recomputed in double precision from the original vectors, terms added in
order of dimension, and the k best of a tile are merged by heaps, in two levels.

Of equal vectors in a tile only the k + 1 with least id can be among the k nearest (ties go to the
smaller id, and a query leaves out itself), so a vector shared by many rows costs no more.

Cases: vectors that are null, empty, zero, or hold a null or a component that is not finite take no
part, nor do rows with a null id; a dimension is compared with its like only; repeated ids are separate
candidates, all left out for the query of that id; fewer than k candidates give fewer rows; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillwarden.llm.shared import written

TILE = 4096  # candidates in a tile
BLOCK = 1024  # queries in a block
MERGE = 64  # tiles merged at once
ROUNDING = 1e-6  # share of the bounds given to rounding in single precision

PACKED = "part long, dim int, n int, ids binary, vectors binary"


def _usable(vector: Column) -> Column:
    """Finite in every component and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _packed(rows: DataFrame, size: int, keep_equal: int | None, name: str) -> DataFrame:
    """Rows of (id, vector) packed into parts of at most ``size`` of one dimension, numbered 0, 1, ...

    Of equal vectors in a part only the ``keep_equal`` with least id stay, if given.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}

        def flush(dim: int) -> pa.RecordBatch:
            own = held.pop(dim)
            if keep_equal is not None:
                own.sort(key=lambda r: (r[1], r[0]))
                kept, same, count = [], None, 0
                for row in own:
                    count = count + 1 if row[1] == same else 1
                    same = row[1]
                    if count <= keep_equal:
                        kept.append(row)
                own = kept
            ids = np.array([i for i, _ in own], dtype="<i8").tobytes()
            columns = [[0], [dim], [len(own)], [ids], [b"".join(v for _, v in own)]]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "dim", "n", "ids", "vectors"]
            )

        for batch in batches:
            for i, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.asarray(vector.values, dtype="<f8") + 0.0  # -0.0 and 0.0 are one value
                held.setdefault(len(values), []).append((i, values.tobytes()))
                if len(held[len(values)]) >= size:
                    yield flush(len(values))
        for dim in list(held):
            yield flush(dim)

    parts = written(rows.mapInArrow(pack, PACKED).drop("part").withColumn("at", F.monotonically_increasing_id()), name)
    # number the parts: the partitions' counts are summed, one row per input partition
    task = F.shiftrightunsigned("at", 33)
    from pyspark.sql import Window

    counts = parts.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("c"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    return parts.join(bases, task == F.col("task")).select(
        (F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("part"), "dim", "n", "ids", "vectors"
    )


def _quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and exact errors of the rows of a matrix."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes, scale, error


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: strips of 1,024 dimensions stay below 2**24 in single precision."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        strip = slice(at, at + 1024)
        out += a[:, strip].astype(np.float32) @ b[:, strip].astype(np.float32).T
    return out


def _distances(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Euclidean distances, squares added one dimension after the other."""
    total = np.zeros(len(candidates))
    for j in range(len(query)):
        total += (candidates[:, j] - query[j]) ** 2
    return np.sqrt(total)


def search_tile(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its id, and ids and distances of its k nearest in the tile, nearest first."""
    code, scale, error = _quantised(vectors)
    norm = (scale**2) * (code.astype(np.float64) ** 2).sum(axis=1)
    q_code, q_scale, q_error = _quantised(queries)
    q_norm = (q_scale**2) * (q_code.astype(np.float64) ** 2).sum(axis=1)
    for at in range(0, len(queries), 64):
        part = slice(at, at + 64)
        dots = _products(q_code[part], code) * q_scale[part, None] * scale[None, :]
        sizes = q_norm[part, None] + norm[None, :]
        square = sizes - 2 * dots
        about = np.sqrt(np.maximum(square, 0))
        # the error of a root: |sqrt(a) - sqrt(b)| <= sqrt(|a - b|), with |a - b| from rounding
        slack = q_error[part, None] + error[None, :] + np.sqrt(sizes * ROUNDING**2)
        own = ids[None, :] == query_ids[part, None]
        upper = np.where(own, np.inf, about + slack)
        lower = np.where(own, np.inf, about - slack)
        if len(ids) > k:
            limit = np.partition(upper, k - 1, axis=1)[:, k - 1]
        else:
            limit = np.full(len(upper), np.inf)
        for i in range(len(upper)):
            alive = np.flatnonzero((lower[i] <= limit[i]) & ~own[i])
            exact = _distances(queries[at + i], vectors[alive])
            best = np.lexsort((ids[alive], exact))[:k]
            yield int(query_ids[at + i]), ids[alive[best]], exact[best]


FOUND = "query_id long, group long, vec_id long, score double"


def _tile_results(tiles: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The k nearest of every query within every tile of its dimension."""
    heights = blocks.groupBy("dim").agg(F.max("part").alias("last_block"), F.min("part").alias("first_block"))
    spread = tiles.join(heights.select(F.col("dim").alias("d"), "first_block", "last_block"), F.col("dim") == F.col("d"))
    spread = spread.withColumn("block", F.explode(F.sequence("first_block", "last_block")))
    widths = tiles.groupBy("dim").agg(F.max("part").alias("last_tile"), F.min("part").alias("first_tile"))
    over = blocks.join(widths.select(F.col("dim").alias("d"), "first_tile", "last_tile"), F.col("dim") == F.col("d"))
    over = over.select(
        F.explode(F.sequence("first_tile", "last_tile")).alias("tile"), F.col("part").alias("q_block"),
        F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
    )
    met = spread.join(
        over,
        (F.col("part") == F.col("tile")) & (F.col("block") == F.col("q_block")) & (F.col("dim") == F.col("q_dim")),
    ).select("part", "dim", "ids", "vectors", "q_ids", "q_vectors")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, dim, ids, vectors, q_ids, q_vectors in zip(*batch.columns, strict=True):
                numbers = [np.frombuffer(x.as_buffer(), dtype="<i8") for x in (q_ids, ids)]
                matrices = [np.frombuffer(x.as_buffer(), dtype="<f8") for x in (q_vectors, vectors)]
                width = dim.as_py()
                found = search_tile(
                    numbers[0], matrices[0].reshape(-1, width), numbers[1], matrices[1].reshape(-1, width), k
                )
                queries, others, scores = [], [], []
                for query, near, score in found:
                    queries.append(np.full(len(near), query))
                    others.append(near)
                    scores.append(score)
                queries, others, scores = (np.concatenate(x) for x in (queries, others, scores))
                group = np.full(len(queries), part.as_py() // MERGE, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.astype(np.int64)), pa.array(group), pa.array(others), pa.array(scores)],
                    ["query_id", "group", "vec_id", "score"],
                )

    # a row holds a whole tile and block, so a few rows are a batch
    return met.repartition(F.col("part"), F.col("q_ids")).mapInArrow(search, FOUND)


def _merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k nearest of each key, by a heap over its rows."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        pairs = zip(rows["score"].to_numpy(), rows["vec_id"].to_numpy(), strict=True)
        best = heapq.nsmallest(k, pairs)
        head = rows.iloc[0]
        return pd.DataFrame(
            {
                "query_id": np.full(len(best), head["query_id"], dtype=np.int64),
                "group": np.full(len(best), head["group"], dtype=np.int64),
                "vec_id": np.array([b[1] for b in best], dtype=np.int64),
                "score": np.array([b[0] for b in best], dtype=np.float64),
                "rank": np.arange(1, len(best) + 1, dtype=np.int32),
            }
        )

    return found.groupBy(*keys).applyInPandas(merge, f"{FOUND}, rank int")


def nearest(vectors: DataFrame, id_column: str, vector_column: str, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of every query row, itself left out.

    ``is_query`` is a condition on ``vectors``.  A repeated query id is one query for its first vector.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    asked = rows.filter("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    tiles = _packed(rows.select("id", "vector"), TILE, k + 1, "tiles")
    blocks = _packed(asked, BLOCK, None, "query-blocks")
    by_tile = _tile_results(tiles, blocks, k)
    by_group = _merged(by_tile, ["query_id", "group"], k).drop("rank")
    return _merged(by_group, ["query_id"], k).select("query_id", "rank", "vec_id", "score")
