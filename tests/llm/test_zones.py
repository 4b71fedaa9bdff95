import hashlib
from collections import Counter

import numpy as np
import pytest

from ordinalis.llm import zones


def plain(rows, k, rounds, seed, scale, dims):
    """rows: (id, vector). Counter of (id, cluster, distance, cluster_inertia, inertia, centroid)."""
    kept = [(key, [int(np.floor(np.float64(x) * scale)) for x in v]) for key, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]

    def assign():
        out = []
        for _, v in kept:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((apart.index(min(apart)), min(apart)))
        return out

    for _ in range(rounds):
        at = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (n, _) in zip(kept, at) if n == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assign()
    inertia = Counter()
    for c, d in at:
        inertia[c] += d
    return Counter((key, c, d, inertia[c], sum(inertia.values()), tuple(centroids[c])) for (key, _), (c, d) in zip(kept, at))


def made(df):
    return Counter((r[0], r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in df.collect())


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(k, v, "x", 1) for k, v in rows], f"vec_id long, embedding array<{kind}>, cluster string, _key int")


def vectors(n, dims, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    return [(i, (centres[i % 5] + rng.normal(size=dims) * 0.1).tolist()) for i in range(n)]


@pytest.mark.parametrize("block,rows_per_range", [(4, 50), (256, 200_000)])
def test_equals_plain_loops(spark, monkeypatch, block, rows_per_range):
    monkeypatch.setattr(zones.blocks, "__defaults__", (block,))
    monkeypatch.setattr(zones, "ROWS_PER_RANGE", rows_per_range)
    nan, inf = float("nan"), float("inf")
    odd = [(1000, None), (1001, []), (1002, [1.0] * 5), (1003, [None] + [1.0] * 5), (1004, [nan] + [1.0] * 5), (1005, [-inf] + [1.0] * 5),
           (1006, [0.0] * 6), (1007, [-0.0] * 6), (None, [0.3] * 6), (None, [0.1] * 6), (7, [0.5] * 6), (7, [0.4] * 6)]
    rows = vectors(300, 6) + odd + [(2000 + i, [0.25] * 6) for i in range(150)]  # a third are equal
    for k, rounds in [(1, 1), (7, 3), (16, 0)]:
        got = zones.cluster(table(spark, rows).repartition(5), k, rounds, dims=6)
        assert got.columns == ["vec_id", "cluster", "distance", "compared", "cluster_inertia", "inertia", "centroid"]
        assert made(got) == plain(rows, k, rounds, 1, 64.0, 6)


def test_few_vectors_and_the_empty_table(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    assert made(zones.cluster(table(spark, rows), 16, 3, dims=2)) == plain(rows, 16, 3, 1, 64.0, 2)
    assert zones.cluster(table(spark, []), 16, 3, dims=2).collect() == []
    assert zones.cluster(table(spark, [(1, None)]), 16, 3, dims=2).collect() == []
    with pytest.raises(ValueError):
        zones.cluster(table(spark, rows), zones.MOST_NUMBERS, 1, dims=2)


def test_large_components_are_exact_or_refused(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) * 1e6).tolist()) for i in range(60)]
    assert made(zones.cluster(table(spark, rows), 5, 2, dims=4)) == plain(rows, 5, 2, 1, 64.0, 4)
    with pytest.raises(Exception, match="is not below"):
        zones.cluster(table(spark, [(1, [1e160] * 4), (2, [1.0] * 4)]), 2, 1, dims=4).collect()


def test_neighbouring_keys_are_neighbouring_cells():
    """In two and three dimensions every step along the whole curve goes to an adjacent cell, and no cell is left out."""
    for dims, bits in [(2, 4), (3, 3)]:
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = zones.curve_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        along = cells[np.argsort([int.from_bytes(k) for k in keys])]
        assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_no_nearest_centroid_is_left_out():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x = rng.integers(-50, 50, size=(20, 3)) // rng.choice([1, 5, 20])
        centroids = rng.integers(-50, 50, size=(9, 3))
        at, apart, compared = zones.nearest(x, x.min(axis=0), x.max(axis=0), centroids)
        every = ((x[:, None, :] - centroids) ** 2).sum(axis=2)
        assert (at == every.argmin(axis=1)).all() and (apart == every.min(axis=1)).all() and compared <= 9


def test_zone_maps_spare_comparisons(spark):
    rows = vectors(2000, 8, seed=5)
    got = zones.cluster(table(spark, rows), 16, 2, dims=8)
    assert got.groupBy().avg("compared").first()[0] < 12


def test_query_counts_every_vector(spark, sf_dir):
    from ordinalis.llm import queries
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    wanted = plain(rows, 16, 3, 1, 64.0, 64)
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    got = Counter(tuple(r) for r in queries.op13_zone_clusters(spark, sf_dir).collect())
    assert got == Counter((key, c, d, ci, i, digest(m)) for key, c, d, ci, i, m in wanted.elements())
