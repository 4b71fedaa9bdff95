"""Importance resampling towards a target distribution, by hashed n-gram features.

A text is lower-cased (A-Z only) and its separators collapse to single spaces. One overlapped
regex scan per n, with lookarounds for the boundaries, then gives the spans of all runs of n
words; each span's bytes go to CRC-32 and so to a bucket. The buckets of the corpus and of the
target are counted, a bucket's gain is the scaled log ratio of its smoothed shares, and a
document's weight is the sum over its features. Noise from the document's id (Gumbel) turns the
highest scores into a sample without replacement.

Texts are scanned once: each document's counts are written, and both the corpus counts and the
weights are made from them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordinalis.llm.common import Recent, small_batches, worker_state
from ordinalis.storage import cut

#: Most buckets: a task holds a counter for each, and the driver their gains.
MOST_BUCKETS = 1 << 20

#: Rows that one task numbers when the drawn documents are put in order.
ROWS_PER_RANGE = 500_000

#: Ranks are right whatever this is; it only says how close to the cut the first estimate lies.
_ACCURACY = 10_000

def _folded(byte: int) -> int:
    """Letters of ASCII in lower case; the other ASCII characters but digits are separators."""
    letter = chr(byte)
    return byte if byte >= 0x80 else ord(letter.lower()) if letter.isalnum() else 0x20


_FOLDED = bytes(map(_folded, range(256)))


def collapsed(text: bytes) -> bytes:
    """The text folded, with one space between words and none around them."""
    return b" ".join(text.translate(_FOLDED).split())


def run_pattern(n: int):
    """Matches a run of ``n`` words of a collapsed text, from one boundary to another."""
    import regex

    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (n - 1))


class _Scanner:
    def __init__(self, least_n: int, most_n: int, buckets: int):
        self._patterns = [run_pattern(n) for n in range(least_n, most_n + 1)]
        self._buckets = Recent(lambda run: zlib.crc32(run) % buckets)

    def counts(self, text: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
        """(words, the buckets of the text's features, how often each occurs)."""
        plain = collapsed(text or b"")
        words = plain.count(b" ") + 1 if plain else 0
        buckets = self._buckets
        found = [buckets[m[0]] for pattern in self._patterns for m in pattern.finditer(plain, overlapped=True)]
        where, times = np.unique(np.array(found, "<u4"), return_counts=True)
        return words, where, times.astype("<u4")


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_n: int = 1, most_n: int = 1,
             buckets: int = 10_000) -> DataFrame:
    """(id_col, n_words, n_features, buckets, counts): every row's features, written once.

    ``buckets`` and ``counts`` are binary: little-endian unsigned 32-bit numbers. A null text,
    or one without words, has no features; repeated rows stay; other columns are dropped.
    """
    if not 1 <= least_n <= most_n or not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"runs of at least one word, and 1 to {MOST_BUCKETS} buckets")
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = worker_state(("spans", least_n, most_n, buckets), lambda: _Scanner(least_n, most_n, buckets))
        for batch in batches:
            found = [scanner.counts(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([int(f[2].sum()) for f in found], pa.int64()),
                 pa.array([f[1].tobytes() for f in found], pa.binary()),
                 pa.array([f[2].tobytes() for f in found], pa.binary())],
                names=["_key", "n_words", "n_features", "buckets", "counts"])

    layout = f"_key {dict(docs.dtypes)[id_col]}, n_words long, n_features long, buckets binary, counts binary"
    rows = docs.select(F.col(id_col).alias("_key"), F.col(text_col).cast("binary").alias("_text"))
    return cut(rows.mapInArrow(scan, layout), "features").withColumnRenamed("_key", id_col)


def bucket_totals(found: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """How many features of all rows fall into each bucket: summed per task, then over the tasks.
    What reaches the driver is bounded by the number of buckets."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for where, times in zip(batch.column(0), batch.column(1)):
                total[np.frombuffer(where.as_py(), "<u4")] += np.frombuffer(times.as_py(), "<u4")
        some = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    partial = found.select("buckets", "counts").mapInArrow(add_up, "bucket long, n long")
    totals = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[row["bucket"]] = row["n"]
    return totals


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of each bucket's smoothed shares, rounded down."""
    all_corpus, all_target, buckets = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(all_corpus + buckets))
                                                / (float(s + 1) * float(all_target + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighed(found: DataFrame, gains: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_words, n_features, weight): the sum of the gains over each row's features."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(gains[np.frombuffer(where.as_py(), "<u4")] @ np.frombuffer(times.as_py(), "<u4").astype(np.int64))
                       for where, times in zip(batch.column(3), batch.column(4))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())],
                                             names=["_key", "n_words", "n_features", "weight"])

    layout = f"_key {dict(found.dtypes)[id_col]}, n_words long, n_features long, weight long"
    return found.withColumnRenamed(id_col, "_key").mapInArrow(add, layout).withColumnRenamed("_key", id_col)


def noise(id_col: str, seed: int) -> Column:
    """A thousand times a Gumbel number, rounded down, from the SHA-256 of ``seed:id`` (null: no id)."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def draw(scored: DataFrame, percent: int, *, id_col: str = "doc_id", least_words: int = 20) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... for the ``percent`` of rows of ``least_words`` words or more
    that score highest (ties to the smaller id, a null one last), null for all others.

    An approximate quantile keeps most rows out; what may be drawn is put in order by ranges of
    (score, id), which also splits rows of one score, and numbered from the ranges' sizes.
    ``scored`` is read more than once, so write it first.
    """
    enough = F.col("n_words") >= least_words
    seen = scored.where(enough).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(
        "score", max(0.0, 1 - percent / 100 - 3 / _ACCURACY), _ACCURACY).alias("border")).first()
    drawn = seen["n"] * percent // 100
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    for border in (seen["border"], None):  # without a border too, should the estimate be too high
        near = enough & (F.lit(True) if border is None else F.col("score") >= border)
        order = [F.desc("score"), F.asc_nulls_last(id_col), F.asc("n_features"), F.asc("weight")]
        ranges = math.ceil(scored.where(near).count() / ROWS_PER_RANGE)
        ordered = (scored.where(near).repartitionByRange(max(1, ranges), *order).sortWithinPartitions(*order)
                   .withColumn("_place", F.monotonically_increasing_id()))
        numbered = cut(ordered, "drawn")
        part = F.shiftrightunsigned("_place", 33)
        sizes = {r["part"]: r["n"] for r in numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
        if sum(sizes.values()) >= drawn:
            break
    before, starts = 0, []
    for key in sorted(sizes):
        starts += [F.lit(key), F.lit(before).cast("long")]
        before += sizes[key]
    start = F.create_map(*starts)[part]
    rank = start + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    ranked = numbered.withColumn("rank", F.when(rank <= drawn, rank)).drop("_place")
    return ranked.unionByName(scored.where(~F.coalesce(near, F.lit(False))).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int, *, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", least_n: int = 1, most_n: int = 1, buckets: int = 10_000, seed: int = 2024,
             least_words: int = 20) -> DataFrame:
    """(id_col, n_words, n_features, weight, score, rank), one row per row of ``docs``.

    Drawn are ``percent`` of the rows that have ``least_words`` words, the nearer to ``target`` the
    likelier; their rank counts from 1, that of others is null. A null text or one without words
    has no features and weight 0. Repeated rows are rows of their own; a null id draws its noise
    from the empty string; other columns are dropped. An empty ``target`` leaves the smoothed
    shares, an empty ``docs`` gives no rows.
    """
    found = features(docs, id_col=id_col, text_col=text_col, least_n=least_n, most_n=most_n, buckets=buckets)
    wanted = features(target.select(F.lit(0).alias("_key"), F.col(target_col).alias("_text")), id_col="_key",
                      text_col="_text", least_n=least_n, most_n=most_n, buckets=buckets)
    gains = bucket_gains(bucket_totals(found, buckets), bucket_totals(wanted, buckets))
    scored = weighed(found, gains, id_col).withColumn("score", F.col("weight") + noise(id_col, seed))
    return draw(cut(scored, "scored"), percent, id_col=id_col, least_words=least_words)
