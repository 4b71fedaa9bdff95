"""Centroid clustering over zone maps along a space-filling curve.

Vectors become integers, so every distance and mean is exact. They are put in the order of a
Hilbert curve through all their components and cut into blocks of neighbours, each with its
box of least and largest components. In a round, the box bounds the distances of all of a
block's vectors to a centroid: a centroid that is farther from the nearest point of the box
than another is from its farthest point can't be nearest to any of them. The centroids that
remain, often few, are compared with the block's vectors exactly, in one array operation.

Blocks are written once and read in every round; a task leaves its sums per centroid and
component, so what is shuffled and what reaches the driver is bounded by centroids times components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ordinalis.llm.common import small_batches
from ordinalis.storage import cut

#: Vectors of a block: few enough for tight boxes, enough for array operations.
BLOCK = 64

#: Bits of each component that the curve follows.
CURVE_BITS = 4

#: Vectors of a range of the curve, one task's share.
ROWS_PER_RANGE = 200_000

#: Centroids times components that the driver may hold.
MOST_NUMBERS = 1 << 20


def curve_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Where each row of ``cells`` (integers of ``bits`` bits) lies on a Hilbert curve: byte strings
    that sort along it.

    The axes are turned and mirrored from the coarsest bit down, as the curve enters each cell;
    Gray code makes numbers of them, whose bits are then taken in turn from all components.
    """
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(dims):
            high = (x[i] >> level & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    turns = np.stack([x >> level & 1 for level in range(bits - 1, -1, -1)])  # level, component, row
    packed = np.packbits(turns.reshape(bits * dims, -1).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The numbers of the centroids that may be nearest to a point of the box, in order."""
    gap = np.maximum(0, np.maximum(low - centroids, centroids - high))
    reach = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return np.flatnonzero((gap ** 2).sum(axis=1) <= (reach ** 2).sum(axis=1).min())


def nearest(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple:
    """(centroid, squared distance) of a block's vectors, ties to the smaller number, and how many
    centroids they were compared with."""
    some = candidates(low, high, centroids)
    near = centroids[some]
    largest = max(np.abs(low).max(initial=0), np.abs(high).max(initial=0), np.abs(near).max(initial=0))
    if 4 * vectors.shape[1] * int(largest) ** 2 < 1 << 53:  # doubles hold every number that occurs
        x, c = vectors.astype(np.float64), near.astype(np.float64)
        apart = (x ** 2).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c ** 2).sum(axis=1)
    else:
        apart = ((vectors[:, None, :] - near) ** 2).sum(axis=2)
    at = apart.argmin(axis=1)
    return some[at], apart[np.arange(len(at)), at].astype(np.int64), len(some)


def _limit(dims: int) -> int:
    """Components stay below this, so that squared distances fit into 64 bits, and they into 32."""
    return min(1 << 30, math.isqrt((1 << 61) // max(dims, 1)) // 2)


def usable(vectors: DataFrame, dims: int, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """(_id, _vector array<long>): the whole vectors, each component times ``scale`` and rounded down."""
    value, limit = F.col(vector_col), float(_limit(dims))
    number = lambda x: x.cast("double")
    finite = ~F.exists(value, lambda x: x.isNull() | F.isnan(number(x)) | (F.abs(number(x)) == float("inf")))
    too_large = F.raise_error(F.lit(f"a component times {scale} is not below {limit}")).cast("long")
    scaled = lambda x: F.when(F.abs(number(x) * scale) < limit, F.floor(number(x) * scale)).otherwise(too_large)
    # one expression, because a filter may run after the projection that would fail on its rows
    whole = F.coalesce((F.size(value) == dims) & finite, F.lit(False))
    return (vectors.select(F.col(id_col).alias("_id"), F.when(whole, F.transform(value, scaled)).alias("_vector"))
            .where(F.col("_vector").isNotNull()))


def _box(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Least and largest of every component, and the number of rows: a few numbers per task."""

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n = None, None, 0
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            if len(x):
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(low), pa.array(high),
                                              pa.array(np.full(dims, n))], names=["i", "low", "high", "n"])

    found = rows.select("_vector").mapInArrow(extremes, "i long, low long, high long, n long")
    got = found.groupBy("i").agg(F.min("low"), F.max("high"), F.sum("n")).orderBy("i").collect()
    return np.array([r[1] for r in got]), np.array([r[2] for r in got]), got[0][3] if got else 0


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def blocks(rows: DataFrame, dims: int, block: int = BLOCK) -> DataFrame:
    """(ids, vectors, low, high): ``rows`` along the curve, in blocks, written once.

    The three binary columns hold little-endian signed 32-bit numbers. Ranges of the curve go
    to tasks by (key, place of the row), so equal vectors spread too.
    """
    low, high, n = _box(rows, dims)
    span = np.maximum(high - low, 1) if n else np.ones(dims, np.int64)

    def on_curve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            if len(x):
                cells = ((x - low) * ((1 << CURVE_BITS) - 1) + span // 2) // span
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([v.tobytes() for v in x.astype("<i4")], pa.binary()),
                     pa.array(curve_keys(cells, CURVE_BITS), pa.binary()), pa.array(np.arange(place, place + len(x)))],
                    names=["_id", "_vector", "_key", "_place"])
                place += len(x)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, kind = [], [], None

        def made(size: int) -> pa.RecordBatch:
            x = np.frombuffer(b"".join(vectors[:size]), "<i4").reshape(-1, dims)
            out = pa.RecordBatch.from_arrays(
                [pa.array([ids[:size]], pa.list_(kind)), pa.array([x.tobytes()], pa.binary()),
                 pa.array([x.min(axis=0).tobytes()], pa.binary()), pa.array([x.max(axis=0).tobytes()], pa.binary())],
                names=["ids", "vectors", "low", "high"])
            del ids[:size], vectors[:size]
            return out

        for batch in batches:
            kind = batch.schema.field(0).type
            ids += batch.column(0).to_pylist()
            vectors += batch.column(1).to_pylist()
            while len(ids) >= block:
                yield made(block)
        if ids:
            yield made(block)

    kind = dict(rows.dtypes)["_id"]
    curve = rows.mapInArrow(on_curve, f"_id {kind}, _vector binary, _key binary, _place long")
    ranged = curve.repartitionByRange(max(1, math.ceil(n / ROWS_PER_RANGE)), "_key", "_place").sortWithinPartitions("_key", "_place")
    return cut(ranged.select("_id", "_vector").mapInArrow(grouped, f"ids array<{kind}>, vectors binary, low binary, high binary"),
               "blocks")


def _read(batch: pa.RecordBatch, at: int, dims: int) -> list[np.ndarray]:
    """(vectors, low, high) of one block."""
    return [np.frombuffer(batch.column(name)[at].as_py(), "<i4").astype(np.int64).reshape(-1, dims)
            for name in ("vectors", "low", "high")]


def moved(made: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the means, rounded down, of the vectors nearest to each."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                vectors, low, high = _read(batch, at, dims)
                cluster, _, _ = nearest(vectors, low, high, centroids)
                np.add.at(total, cluster, vectors)
                n += np.bincount(cluster, minlength=k)
        where = np.repeat(n.nonzero()[0], dims)
        i = np.tile(np.arange(dims), len(where) // dims)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(i), pa.array(total[where, i]), pa.array(n[where])],
                                         names=["cluster", "i", "total", "n"])

    partial = made.select("vectors", "low", "high").mapInArrow(sums, "cluster long, i long, total long, n long")
    after = centroids.copy()
    for row in partial.groupBy("cluster", "i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        after[row["cluster"], row["i"]] = row["total"] // row["n"]
    return after


def assigned(made: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(_id, cluster, distance, compared) of every vector."""
    dims, kind = centroids.shape[1], made.schema["ids"].dataType.elementType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                cluster, distance, compared = nearest(*_read(batch, at, dims), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[at].values, pa.array(cluster.astype(np.int32)), pa.array(distance),
                     pa.array(np.full(len(cluster), compared, np.int32))], names=["_id", "cluster", "distance", "compared"])

    return made.mapInArrow(place, f"_id {kind}, cluster int, distance long, compared int")


def cluster(vectors: DataFrame, k: int, rounds: int, *, seed: int = 1, scale: float = 64.0, dims: int = 64,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id_col, cluster, distance, compared, cluster_inertia, inertia, centroid), one row per whole vector.

    Whole vectors have ``dims`` components, none null or non-finite; the others give no row. Each
    component times ``scale`` is rounded down; one too large for exact distances fails the job. The ``k`` whole
    vectors with the smallest SHA-256 of ``seed:id`` start as centroids (a null id as the empty
    string; rows of one id by their vectors), fewer if there are fewer. A round assigns every
    vector to its nearest centroid, ties to the smaller number, and moves each centroid that has
    vectors to their mean, rounded down. ``compared`` tells how many centroids the zone map left.
    Repeated rows all take part; other columns are dropped; an empty table gives no rows.
    """
    if k * dims > MOST_NUMBERS:
        raise ValueError(f"centroids times components must be at most {MOST_NUMBERS}")
    small_batches(vectors.sparkSession)
    rows = usable(vectors, dims, scale, id_col, vector_col)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    first = rows.orderBy(order, "_vector").limit(k).select("_vector").collect()
    centroids = np.array([r[0] for r in first], np.int64).reshape(-1, dims)
    made = blocks(rows, dims)
    for _ in range(rounds if len(first) else 0):
        centroids = moved(made, centroids)
    done = cut(assigned(made, centroids), "assigned").withColumnRenamed("_id", id_col)
    inertia = {r["cluster"]: r["n"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    about = [(c, inertia.get(c, 0), sum(inertia.values()), centroids[c].tolist()) for c in range(len(first))]
    clusters = vectors.sparkSession.createDataFrame(
        about, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return done.join(F.broadcast(clusters), "cluster").select(id_col, "cluster", "distance", "compared", "cluster_inertia",
                                                              "inertia", "centroid")
