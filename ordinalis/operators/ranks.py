"""Seeded shuffles without a global sort: holdout split, folds and mini-batches.

The shuffled order is the order of ``md5(seed:id)``. Its first hex digits cut the rows into
even buckets whose counts give every bucket its offset, so positions are exact while no task
ever sees more than one bucket. ``id`` must be unique.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_BUCKET = 1_000_000


def shuffle_hash(id_col: str, seed: Column | int) -> Column:
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), F.col(id_col).cast("string")))


def _bucket_digits(rows: int) -> int:
    """Hex digits that keep a bucket near a million rows; at most five (1,048,576 buckets)."""
    digits = 1
    while digits < 5 and rows > ROWS_PER_BUCKET * 16 ** digits:
        digits += 1
    return digits


def _bucket_offsets(hashed: DataFrame, digits: int) -> DataFrame:
    """(bucket, offset, rows): at most 16^digits rows, so the running sum fits one task."""
    counts = (hashed.groupBy(F.substring("_h", 1, digits).alias("_bucket"))
              .agg(F.count(F.lit(1)).alias("_rows")))
    before = (Window.partitionBy(F.lit(0)).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def shuffled_rank(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Adds ``rank`` (1..n): the row's place in the shuffled order."""
    digits = _bucket_digits(df.count())
    hashed = df.withColumn("_h", shuffle_hash(id_col, seed))
    offsets = _bucket_offsets(hashed, digits).select("_bucket", "_offset")
    in_bucket = Window.partitionBy("_bucket").orderBy("_h", id_col)
    return (hashed.withColumn("_bucket", F.substring("_h", 1, digits))
            .join(F.broadcast(offsets), "_bucket")
            .withColumn("rank", F.row_number().over(in_bucket) + F.col("_offset"))
            .drop("_h", "_bucket", "_offset"))


def _hashes_at(df: DataFrame, id_col: str, seed: int, places: list[int], rows: int) -> list[str]:
    """The shuffle hash found at each wanted 1-based place: only those buckets are sorted."""
    digits = _bucket_digits(rows)
    hashed = df.select(id_col, shuffle_hash(id_col, seed).alias("_h"))
    wanted = F.filter(F.array(*[F.lit(p).cast("bigint") for p in places]),
                      lambda p: (p > F.col("_offset")) & (p <= F.col("_offset") + F.col("_rows")))
    buckets = (_bucket_offsets(hashed, digits).withColumn("_places", wanted)
               .where(F.size("_places") > 0).select("_bucket", "_offset", "_places"))
    in_bucket = Window.partitionBy("_bucket").orderBy("_h", id_col)
    found = (hashed.withColumn("_bucket", F.substring("_h", 1, digits))
             .join(F.broadcast(buckets), "_bucket")
             .withColumn("rank", F.row_number().over(in_bucket) + F.col("_offset"))
             .where(F.array_contains("_places", F.col("rank")))
             .select("rank", "_h").collect())  # one row per wanted place
    at = {row["rank"]: row["_h"] for row in found}
    return [at[place] for place in places]


def fold_sizes(rows: int, folds: int) -> list[int]:
    """Sizes differ by at most one; the first ``rows mod folds`` folds are the larger ones."""
    small, larger = divmod(rows, folds)
    return [small + (1 if i < larger else 0) for i in range(folds)]


def kfold_assign(df: DataFrame, id_col: str, folds: int, seed: int) -> DataFrame:
    """Adds ``fold`` 0..folds-1 with exact sizes.

    The fold borders are hashes found in two counting passes; the assignment itself compares
    the row's own hash with those few literals, so the data is neither sorted nor shuffled.
    """
    rows = df.count()
    ends, place = [], 0
    for size in fold_sizes(rows, folds)[:-1]:
        place += size
        ends.append(place)
    wanted = sorted({p for p in ends if p > 0})
    at = dict(zip(wanted, _hashes_at(df, id_col, seed, wanted, rows))) if wanted else {}
    fold = F.lit(0)
    own = shuffle_hash(id_col, seed)
    for end in ends:
        fold = fold + ((own > F.lit(at[end])).cast("int") if end else F.lit(1))
    return df.withColumn("fold", fold)


def kfold_hash(df: DataFrame, id_col: str, folds: int, seed: int) -> DataFrame:
    """Folds from the hash alone: no pass over the data, sizes only nearly equal."""
    number = F.conv(F.substring(shuffle_hash(id_col, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("fold", (number % folds).cast("int"))


def holdout_split(df: DataFrame, id_col: str, share: float, seed: int) -> DataFrame:
    """Adds ``is_validation`` for exactly ceil(share * n) rows, chosen by shuffle hash."""
    rows = df.count()
    size = min(rows, math.ceil(share * rows))
    if size == 0:
        return df.withColumn("is_validation", F.lit(False))
    border = _hashes_at(df, id_col, seed, [size], rows)[0]
    return df.withColumn("is_validation", shuffle_hash(id_col, seed) <= F.lit(border))


def batch_assign(df: DataFrame, id_col: str, batch_size: int, seed: int, epoch: int = 1) -> DataFrame:
    """Adds ``batch`` 0..ceil(n/size)-1: the epoch's shuffled mini-batches."""
    ranked = shuffled_rank(df, id_col, seed * 1000 + epoch)
    return ranked.withColumn("batch", F.expr(f"(rank - 1) div {int(batch_size)}")).drop("rank")
