"""Nearest neighbours by a block matrix join with quantised product tiles.

Queries and candidates are dealt into blocks by a hash of their id; every pair of blocks is
one tile, so a task holds two bounded blocks whatever the number of rows. In a tile both
blocks are quantised to int8 (one scale a vector) and multiplied; with the norms of the
rounding errors this bounds every true product from both sides. Candidates whose upper bound
reaches the k-th best lower bound of the tile survive, and their products are recomputed in
double precision on the original vectors, component after component. The tiles' k best are
merged by one heap of k entries a query. The bounds are strict, so the result is exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordinalis.llm.common import shuffle_partitions

BLOCK_ROWS = 8192
QUERY_ROWS = 2048

#: Pairs recomputed at a time.
_PAIRS = 1 << 18
#: int8 products of so many components are exact in the 24 bits of a float.
_EXACT = 1024


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 rows, scales, norms of the quantised rows, norms of the errors); norms are rounded up."""
    scales = np.abs(rows).max(axis=1) / 127
    steps = rows / np.where(scales > 0, scales, 1)[:, None]  # 127 at most, so that no square overflows
    small = np.rint(steps).astype(np.int8)
    up, norms = scales * (1 + 1e-9), np.linalg.norm(small, axis=1)
    return small, scales, norms * up, (np.linalg.norm(steps - small, axis=1) + 1e-12 * norms) * up


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows, by single-precision tiles short enough to be exact."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], _EXACT):
        out += a[:, i:i + _EXACT].astype(np.float32) @ b[:, i:i + _EXACT].astype(np.float32).T
    return out


def exact_products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """a[i] · b[j], added up component after component, so equal vectors have equal products."""
    out = np.zeros(len(i))
    for s in range(0, len(i), _PAIRS):
        x, y = a[i[s:s + _PAIRS]], b[j[s:s + _PAIRS]]
        total = np.zeros(len(x))
        for c in range(a.shape[1]):
            total += x[:, c] * y[:, c]
        out[s:s + _PAIRS] = total
    return out


def best_of_tile(query_ids, queries, ids, vectors, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k best candidates in the tile, its own id left out."""
    small_q, scale_q, norm_q, error_q = quantise(queries)
    small, scale, norm, error = quantise(vectors)
    with np.errstate(over="ignore", invalid="ignore"):  # bounds beyond all doubles bound nothing
        norms = norm + error
        about = int8_products(small_q, small) * scale_q[:, None] * scale
        margin = error_q[:, None] * norms + norm_q[:, None] * error
        margin += 1e-12 * (np.abs(about) + margin)
        sure = np.isfinite(about) & np.isfinite(margin)
        lower, upper = np.where(sure, about - margin, -np.inf), np.where(sure, about + margin, np.inf)
    own = query_ids[:, None] == ids
    lower = np.where(own, -np.inf, lower)
    floor = np.partition(lower, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)]
    i, j = np.nonzero((upper >= floor[:, None]) & ~own)
    with np.errstate(over="ignore", invalid="ignore"):
        scores = exact_products(queries, vectors, i, j)
    scores[np.isnan(scores)] = np.inf
    order = np.lexsort((ids[j], -scores, i))
    i, j, scores = i[order], j[order], scores[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    keep = place < k
    return query_ids[i[keep]], ids[j[keep]], scores[keep]


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    column = table["_vector"].combine_chunks()
    column = column if isinstance(column, pa.Array) else column.chunk(0)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, *, id_col: str = "vec_id",
            vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, id_col, score): the k largest inner products of each query, ties to the
    smaller id; all candidates where there are fewer.

    Unusable vectors and null ids take no part. Rows equal in id and vector count once; several
    vectors of one id all take part, as candidates and as queries whose products are ranked
    together, but never meet each other. Products that overflow are infinite, and so are those
    of infinite parts of both signs. Vectors meet only those of their own dimension. ``is_query``
    may use the id column; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = (vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_vector"),
                           is_query.alias("_query"))
            .where(F.col("_id").isNotNull() & usable(F.col("_vector")))
            .groupBy("_id", "_vector").agg(F.max("_query").alias("_query"))
            .withColumn("_dim", F.size("_vector")))
    n, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("_query"), 1))).first()
    blocks = max(1, math.ceil(n / block_rows))  # of a fixed size: a tile returns k rows a query
    query_blocks = max(1, math.ceil(asked / query_rows))

    def block(of: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(of)).cast("int")

    def every(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    keys = ["_dim", "_row", "_column"]
    candidates = rows.select("_id", "_vector", "_dim", block(blocks, 1).alias("_column"), every(query_blocks).alias("_row"))
    queries = (rows.where("_query")
               .select("_id", "_vector", "_dim", block(query_blocks, 2).alias("_row"), every(blocks).alias("_column")))

    def tile(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = ([], [], [])
        if len(left) and len(right):
            dim = key[0].as_py()
            found = best_of_tile(left["_id"].to_numpy(), _matrix(left, dim), right["_id"].to_numpy(), _matrix(right, dim), k)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heap = None, []

        def ranked():
            return [(now, rank, -other, score) for rank, (score, other) in enumerate(sorted(heap, reverse=True), 1)]

        for batch in batches:
            out = []
            for query, other, score in zip(*(c.to_pylist() for c in batch.columns)):
                if query != now:
                    out += ranked()
                    now, heap = query, []
                if len(heap) < k:
                    heapq.heappush(heap, (score, -other))
                else:
                    heapq.heappushpop(heap, (score, -other))
            yield _ranked_batch(out)
        yield _ranked_batch(ranked())

    best = (queries.groupBy(*keys).cogroup(candidates.groupBy(*keys))
            .applyInArrow(tile, "query_id long, _id long, score double"))
    return (best.repartition(shuffle_partitions(spark), "query_id").sortWithinPartitions("query_id")
            .mapInArrow(merge, "query_id long, rank int, _id long, score double").withColumnRenamed("_id", id_col))


def _ranked_batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    types = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      names=["query_id", "rank", "_id", "score"])
