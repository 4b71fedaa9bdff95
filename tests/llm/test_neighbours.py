import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordinalis.llm import neighbours, queries


def brute(rows, asked, k):
    """rows: distinct id -> vector."""
    found = {}
    for q, v in rows.items():
        if asked(q):
            scored = [(-math.fsum(a * b for a, b in zip(v, w)), i) for i, w in rows.items() if i != q and len(w) == len(v)]
            found[q] = sorted(scored)[:k]
    return found


def compare(result, expected):
    got = {}
    for r in result.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {q for q, best in expected.items() if best}
    for q, best in expected.items():
        mine = sorted(got.get(q, []))
        assert [m[0] for m in mine] == list(range(1, len(best) + 1))
        assert [m[1] for m in mine] == [i for _, i in best]
        assert np.allclose([m[2] for m in mine], [-s for s, _ in best], rtol=1e-12)


@pytest.mark.parametrize("block_rows,query_rows", [(8192, 2048), (40, 7)])
def test_small_integers_with_many_ties(spark, block_rows, query_rows):
    rng = np.random.default_rng(5)
    rows = {i: rng.integers(-2, 3, 6).astype(float).tolist() for i in range(300)}
    rows |= {i: [1.0, 2.0, 0.0, 0.0, 0.0, 1.0] for i in range(300, 420)}  # one common vector
    rows = {i: v for i, v in rows.items() if any(v)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>").repartition(4)
    compare(neighbours.nearest(df, F.col("vec_id") % 20 == 0, 5, block_rows=block_rows, query_rows=query_rows),
            brute(rows, lambda q: q % 20 == 0, 5))


def test_unusable_vectors_other_dimensions_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]),
            (7, [2.0, 1.0]), (8, [1e-30, 0.0]), (20, [1.0, 1.0, 1.0]), (40, [3.0, 1.0, 1.0]), (None, [9.0, 9.0]), (60, [1.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, score string, rank int")
    good = {0: [1.0, 0.0], 7: [2.0, 1.0], 8: [1e-30, 0.0], 20: [1.0] * 3, 40: [3.0, 1.0, 1.0], 60: [1.0]}
    compare(neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20), brute(good, lambda q: q % 20 == 0, 20))
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(40, 1500)) * rng.lognormal(0, 2, (40, 1)), rng.normal(size=(50, 1500))
    (sa, ca, na, ea), (sb, cb, _, eb) = neighbours.quantise(a), neighbours.quantise(b)
    about = neighbours.int8_products(sa, sb) * ca[:, None] * cb
    assert (np.abs(about - a @ b.T) <= ea[:, None] * np.linalg.norm(b, axis=1) + na[:, None] * eb + 1e-9).all()
    assert (neighbours.int8_products(sa, sb) == sa.astype(np.int64) @ sb.astype(np.int64).T).all()


def test_query_over_all_embeddings(spark, sf_dir):
    rows = {r.vec_id: [float(x) for x in r.embedding] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    compare(queries.op1_block_neighbours(spark, sf_dir), brute(rows, lambda q: q % 20 == 0, 20))


@pytest.mark.parametrize("block_rows", [8192, 2])
def test_every_vector_of_a_repeated_id_takes_part(spark, block_rows):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [5.0, 1.0]), (1, [1.0, 4.0]), (2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, 4, block_rows=block_rows).orderBy("rank").collect()
    pairs = sorted((-sum(a * b for a, b in zip(v, w)), i) for q, v in rows for i, w in rows if q == 0 != i)[:4]
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, n, i, -s) for n, (s, i) in enumerate(pairs, 1)]


@pytest.mark.parametrize("size", [1e160, 1e300, 1e-200])
def test_large_and_small_doubles_lose_no_neighbour(spark, size):
    rng = np.random.default_rng(4)
    rows = [(20, [size, 1.0]), *((i, [float(x), float(y)]) for i, (x, y) in enumerate(rng.normal(size=(15, 2)), 1)), (40, [-size, size / 3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, 5).collect()
    vectors = dict(rows)
    for query in (20, 40):
        score = lambda v: vectors[query][0] * vectors[v][0] + vectors[query][1] * vectors[v][1]
        wanted = sorted(((score(v), -v) for v in vectors if v != query), reverse=True)[:5]
        assert [(r.score, -r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == query] == wanted
