"""Document fingerprints: content-defined chunks, their digests, and containment.

A gear hash over the last 32 bytes decides where a chunk may end, so a boundary depends on
the text near it and not on its position: after an insertion the old boundaries come back.
Chunk sizes are normalised: up to ``NORMAL`` bytes a boundary needs eight zero bits, beyond
it six, between ``LEAST`` and ``MOST`` bytes in all. A fingerprint is the set of chunk
digests, each weighted by the bytes of its chunks; the likeness of a to b is the weight of a
that b holds too, over the weight of a.

A null text counts as empty; an empty text has the empty fingerprint, which is like another
empty one (1) and like nothing else (0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ordinalis.llm.common import mix, shuffle_partitions, small_batches

LEAST, NORMAL, MOST = 32, 48, 128
_STRICT, _LOOSE = np.uint32(0xFF000000), np.uint32(0xFC000000)

#: One random-looking number per byte value, from the mixer of ``common``.
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """For each byte the sum of the last 32 gear values, each shifted by its distance."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        if len(h) > step:
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def chunk_ends(data: bytes) -> list[int]:
    """Where chunks end, the last at the end of the data."""
    n = len(data)
    h = gear_hashes(np.frombuffer(data, np.uint8))
    loose = np.flatnonzero((h & _LOOSE) == 0)
    strict = (loose[(h[loose] & _STRICT) == 0] + 1).tolist()
    loose = (loose + 1).tolist()
    ends, start = [], 0
    while n - start > LEAST:
        i = bisect_left(strict, start + LEAST)
        if i < len(strict) and strict[i] < start + NORMAL:
            end = strict[i]
        else:
            i = bisect_left(loose, start + NORMAL)
            end = min(loose[i] if i < len(loose) else n, start + MOST, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def chunk_weights(text: str | None) -> dict[int, int]:
    """digest -> bytes of the chunks with that digest."""
    import xxhash

    data = (text or "").encode("utf-8", "surrogatepass")
    weights: dict[int, int] = {}
    start = 0
    for end in chunk_ends(data):
        digest = xxhash.xxh3_64_intdigest(data[start:end])
        weights[digest] = weights.get(digest, 0) + end - start
        start = end
    return weights


def written(weights: dict[int, int]) -> str:
    """``digest:weight`` in hex, ordered by digest, joined by commas."""
    return ",".join([f"{digest:016x}:{weight:x}" for digest, weight in sorted(weights.items())])


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """The share of a's weight that b holds; 1 for two empty ones."""
    if not a:
        return float(not b)
    return sum([min(weight, b[digest]) for digest, weight in a.items() if digest in b]) / sum(a.values())


def fingerprint(text: Column | str) -> Column:
    """The written fingerprint of each whole text."""

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([written(chunk_weights(t.as_py())) for t in texts], pa.string())

    return of(text)


def likeness(a: Column | str, b: Column | str) -> Column:
    """Containment of one written fingerprint in another; null where either is null."""

    def read(text: str) -> dict[int, int]:
        return {int(d, 16): int(w, 16) for d, w in (part.split(":") for part in text.split(",") if part)}

    @F.arrow_udf("double")
    def of(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else containment(read(x), read(y))
                         for x, y in zip(left.to_pylist(), right.to_pylist())], pa.float64())

    return of(a, b)


def with_next(docs: DataFrame, id_col: str, text_col: str, rows: Callable, schema: str) -> DataFrame:
    """``rows(pairs)`` over every document and the one that follows it in descending id.

    ``pairs`` yields (id, text, next text); after the last document comes the first. Texts are
    shuffled once: ranges of ids are found from the ids alone (what reaches the driver is two
    ids a range), each range is one bucket, and the first documents of a range also go to the
    bucket before it. Of equal ids the smaller text comes first, null ids come last.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = 4 * shuffle_partitions(spark)
    ids = docs.select(F.col(id_col).alias("_id")).where("_id is not null")
    ranges = (ids.repartitionByRange(buckets, "_id").groupBy(F.spark_partition_id().alias("_part"))
              .agg(F.min("_id").alias("low"), F.max("_id").alias("high")).orderBy("low").collect())
    low, high = [r["low"] for r in ranges], [r["high"] for r in ranges]

    @F.arrow_udf("array<int>")
    def places(keys: pa.Array) -> pa.Array:
        """The bucket of an id, and the one before where the id is the first of its bucket."""
        out = []
        for key in keys.to_pylist():
            at = bisect_right(low, key) - 1 if key is not None else 0
            first = key is not None and high[at] == key
            out.append([at, (at + 1) % len(low)] if first else [at])
        return pa.array(out, pa.list_(pa.int32()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            now = first = waiting = None  # waiting: (id, text) whose next text isn't known yet
            for batch in batches:
                for at, border, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if at != now:
                        if waiting:
                            yield *waiting, first
                        now, first, waiting = at, text, None
                    if waiting:
                        yield *waiting, text
                    waiting = None if border else (key, text)
            if waiting:
                yield *waiting, first  # ids are all null: one bucket without a border

        return rows(pairs())

    dealt = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
             .withColumn("_places", places("_id"))
             .select("_id", "_text", F.posexplode("_places").alias("_border", "_at")))
    return (dealt.select("_at", "_border", "_id", "_text")
            .repartition(shuffle_partitions(spark), "_at")
            .sortWithinPartitions("_at", "_border", F.col("_id").desc(), F.col("_text").asc())
            .mapInArrow(walk, schema))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edit_comparison(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text (see ``edited``), and how much of
    its own each of the edited text's and the next document's fingerprint holds.

    Columns: id_col, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited,
    near_next. Repeated rows give repeated rows; other columns are dropped; an empty table
    gives an empty result.
    """
    id_type = dict(docs.dtypes)[id_col]
    schema = (f"_id {id_type}, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def rows(pairs) -> Iterator[pa.RecordBatch]:
        out, last = [], None  # the next text's fingerprint is the next pair's own
        for key, text, following in pairs:
            text, following = text or "", following or ""
            own = last[1] if last and last[0] is text else chunk_weights(text)
            other = edited(text, following)
            its, next_one = chunk_weights(other), chunk_weights(following)
            last = (following, next_one)
            out.append((key, len(text), other, written(own), written(its), containment(own, its),
                        containment(own, next_one)))
            if len(out) == 500:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    def _batch(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return with_next(docs, id_col, text_col, rows, schema).withColumnRenamed("_id", id_col)
