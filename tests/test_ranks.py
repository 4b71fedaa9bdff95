"""Splits: exact sizes, independence of partitioning, and many buckets."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from ordinalis.operators import ranks


def by_hash(n, seed):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("n, folds", [(47, 10), (3, 5), (1000, 7), (10, 10)])
def test_folds_match_a_global_sort(spark, n, folds):
    got = {r.id: r.fold for r in ranks.kfold_assign(spark.range(n), "id", folds, 42).collect()}
    order, expected, start = by_hash(n, 42), {}, 0
    for fold, size in enumerate(ranks.fold_sizes(n, folds)):
        expected.update({i: fold for i in order[start:start + size]})
        start += size
    assert got == expected
    assert ranks.fold_sizes(47, 10) == [5] * 7 + [4] * 3


def test_ranks_with_many_buckets_and_partitions(spark, monkeypatch):
    expected = {i: place + 1 for place, i in enumerate(by_hash(2000, 7))}
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 3)  # forces the deepest buckets
    for partitions in (1, 4, 200):
        df = spark.range(0, 2000, 1, partitions)
        got = {r.id: r["rank"] for r in ranks.shuffled_rank(df, "id", 7).collect()}
        assert got == expected
        folds = ranks.kfold_assign(df, "id", 10, 7).groupBy("fold").count().collect()
        assert [r["count"] for r in folds] == [200] * 10


def test_holdout_size_and_batches(spark):
    for n, share in ((48, 0.2), (47, 0.2), (5, 0.0), (5, 1.0)):
        got = ranks.holdout_split(spark.range(n), "id", share, 42).where("is_validation").count()
        assert got == math.ceil(share * n)
    sizes = ranks.batch_assign(spark.range(50), "id", 16, 42).groupBy("batch").count().orderBy("batch").collect()
    assert [tuple(r) for r in sizes] == [(0, 16), (1, 16), (2, 16), (3, 2)]


def test_hash_folds_are_nearly_even(spark):
    counts = [r["count"] for r in ranks.kfold_hash(spark.range(10000), "id", 10, 42).groupBy("fold").count().collect()]
    assert len(counts) == 10 and min(counts) > 850


def test_fold_assignment_neither_sorts_nor_shuffles(spark):
    plan = ranks.kfold_assign(spark.range(1000), "id", 10, 42)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
