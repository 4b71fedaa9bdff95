"""Best-fit packing: whole documents into as few sequences as possible, by bin completion.

Documents are cut only where they are longer than a sequence. Pieces that fill a sequence are
placed where they are; the others are dealt into groups of about ``group_items`` by a hash of
their place, which is even whatever the ids. A group is solved on the counts of its lengths:
best fit decreasing gives the incumbent, and a depth-first search around the largest piece
left enumerates undominated fillings of its sequence, best first, each taken as often as the
counts allow. A branch ends when its waste, or a lower bound of what is left, can no longer
beat the incumbent. The search stops at the bound or after ``nodes`` steps; what it returns
is never worse than best fit.

The pieces, ids included, are written once; only places and lengths are grouped.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ordinalis.llm.common import small_batches
from ordinalis.storage import fresh_path

#: A filling: ((length, how often), ...), and how many sequences have it.
Filled = tuple[tuple[tuple[int, int], ...], int]

#: Multiplicities up to this are all tried; larger ones are halved.
_EVERY = 8

_WHOLE = 1 << 62


def least_bins(left: np.ndarray, capacity: int) -> int:
    """A lower bound: pieces over half a sequence need one each, and those of at least k must fit
    into the room that is left beside the ones short enough to share with them."""
    sizes = np.arange(capacity + 1)
    n = np.concatenate([np.cumsum(left[::-1])[::-1], [0]])  # pieces of at least this length
    total = np.concatenate([np.cumsum((left * sizes)[::-1])[::-1], [0]])
    half, k = capacity // 2 + 1, np.arange(0, capacity // 2 + 1)
    alone = n[capacity - k + 1]
    shared, shared_total = n[half] - alone, total[half] - total[capacity - k + 1]
    over = total[k] - total[half] - (shared * capacity - shared_total)
    return int((n[half] + np.maximum(0, -(-over // capacity))).max())


def best_fit(left: np.ndarray, capacity: int) -> list[Filled]:
    """Best fit decreasing on counts: sequences of equal contents are one entry."""
    open_, done = [], []  # open_: (room, filling, times), by room
    for size in np.flatnonzero(left)[::-1].tolist():
        n = int(left[size])
        while n:
            at = bisect_left(open_, (size,))  # the least room that fits
            if at < len(open_):
                room, filling, times = open_.pop(at)
            else:
                room, filling, times = capacity, (), n  # as many new ones as could be wanted
            each = min(room // size, n)
            used = min(times, n // each)
            n -= used * each
            if filling and used < times:
                insort(open_, (room, filling, times - used))
            more = (*filling, (size, each))
            if room > each * size:
                insort(open_, (room - each * size, more, used))
            else:
                done.append((more, used))
    return done + [(filling, times) for _, filling, times in open_]


def _fillings(left: np.ndarray, largest: int, capacity: int, slack: int, width: int) -> list[tuple[int, tuple]]:
    """(waste, filling) around one piece of length ``largest``: at most ``width`` of the undominated
    ones with the least waste, none that wastes more than ``slack``."""
    room = capacity - largest
    counts = {s: int(n) for s, n in enumerate(left[:room + 1].tolist()) if n}
    if largest in counts:
        counts[largest] -= 1
    sizes = [s for s in sorted(counts) if counts[s] > 0]
    reach = [1]  # reach[i]: a bit for each sum of the i shortest lengths
    for s in sizes:
        bits, n, step = reach[-1], min(counts[s], room // s), 1
        while n:
            step = min(step, n)
            bits |= bits << s * step
            n -= step
            step *= 2
        reach.append(bits & (1 << room + 1) - 1)

    def exactly(rest: int, i: int, taken: tuple) -> Iterator[tuple]:
        if rest == 0:
            yield taken
            return
        for j in range(min(i, bisect_left(sizes, rest + 1)) - 1, -1, -1):
            if not reach[j + 1] >> rest & 1:
                return
            s = sizes[j]
            for times in range(min(counts[s], rest // s), 0, -1):
                if reach[j] >> rest - times * s & 1:
                    yield from exactly(rest - times * s, j, (*taken, (s, times)))

    unused = sum(1 << s for s in sizes)
    found, seen = [], 0
    for waste in range(0, min(slack, room) + 1):
        if not reach[-1] >> room - waste & 1:
            continue
        for filling in exactly(room - waste, len(sizes), ()):
            seen += 1
            if not _dominated(filling, waste, unused, counts):
                found.append((waste, filling))
            if len(found) >= width or seen >= 8 * width or (filling == ((room, 1),)):
                return found
    return found


def _dominated(filling: tuple, waste: int, unused: int, counts: dict[int, int]) -> bool:
    """Whether one unused piece could take the place of some of the filling's: of shorter ones that
    fit into its place, or of two or more that are exactly as long. ``unused`` has a bit for each
    length that there is."""
    free = unused & ~sum(1 << s for s, times in filling if times == counts[s])
    sums = several = 0  # bits for the sums of one or more, and of two or more pieces
    for s, times in filling:
        for _ in range(times):
            several |= sums << s
            sums |= sums << s | 1 << s
    span = 1
    while span < waste:  # bits for 0 .. waste - 1 above each sum
        step = min(span, waste - span)
        sums |= sums << step
        span += step
    return bool(free & (several | (sums << 1 if waste else 0)))


def complete_bins(counts: np.ndarray, capacity: int, nodes: int = 300, width: int = 24) -> list[Filled]:
    """Fillings, with how many sequences each has, that use up ``counts`` (pieces of each length)."""
    left = np.array(counts, dtype=np.int64)
    best = best_fit(left, capacity)
    fewest, bound = sum(t for _, t in best), least_bins(left, capacity)
    budget = nodes + 2 * int((left > 0).sum())
    chosen: list[Filled] = []
    used = 0

    def choices() -> Iterator[Filled]:
        """The ways to go on from here, after looking for a better end."""
        nonlocal best, fewest, budget
        budget -= 1
        if not left.any():
            if used < fewest:
                best, fewest = list(chosen), used
            return
        if used + least_bins(left, capacity) >= fewest:
            return
        if chosen and (budget % 16 == 0 or budget <= nodes):
            rest = best_fit(left, capacity)
            if used + sum(t for _, t in rest) < fewest:
                best, fewest = chosen + rest, used + sum(t for _, t in rest)
        slack = (fewest - 1 - used) * capacity - int((left * np.arange(capacity + 1)).sum())
        largest = int(np.flatnonzero(left)[-1])
        for waste, filling in _fillings(left, largest, capacity, slack, width):
            whole = Counter(dict(filling))
            whole[largest] += 1
            most = min(int(left[s]) // n for s, n in whole.items())
            if waste:
                most = min(most, slack // waste)
            pattern = tuple(sorted(whole.items(), reverse=True))
            while most > 0:
                yield pattern, most
                most = most - 1 if most <= _EVERY else most // 2

    stack = [choices()] if fewest > bound else []
    while stack and budget > 0 and fewest > bound:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if chosen:
                filling, times = chosen.pop()
                used -= times
                for s, n in filling:
                    left[s] += n * times
            continue
        filling, times = step
        for s, n in filling:
            left[s] -= n * times
        chosen.append(step)
        used += times
        stack.append(choices())
    return best


def _place(lengths: np.ndarray, filled: list[Filled]) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece; pieces of one length are taken in order."""
    order = np.argsort(lengths, kind="stable")
    first = np.searchsorted(lengths[order], np.arange(lengths.max(initial=0) + 2))
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for filling, times in filled:
        at = 0
        for size, n in filling:
            rows = order[first[size]:first[size] + n * times]
            first[size] += n * times
            sequence[rows] = made + np.repeat(np.arange(times), n)
            offset[rows] = at + np.tile(np.arange(n) * size, times)
            at += n * size
        made += times
    return sequence, offset


def pack_whole(docs: DataFrame, encode: Callable[[str | None], np.ndarray], end_id: int, *, id_col: str = "doc_id",
               text_col: str = "text", length: int = 2048, group_items: int = 1_000_000, nodes: int = 300) -> DataFrame:
    """(id_col, piece, start, length, ids, sequence_id, offset), one row per piece.

    ``encode`` gives the ids of a text, ``end_id`` follows every document, so a null or empty text
    is one piece of one id. A document of more than ``length`` ids is cut into pieces of that
    length, of which the first may be shorter. ``ids`` is binary: little-endian unsigned 32-bit
    numbers. Equal rows, ids included, are separate documents; a null id is kept; other columns
    are dropped, so their names don't matter; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    small_batches(spark)
    layout = f"_key {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids binary, _part int, _row long"

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys, pieces, starts, found = [], [], [], []
            schema = pa.schema([("_key", batch.schema.field(0).type), ("piece", pa.int32()), ("start", pa.int64()),
                                ("length", pa.int64()), ("ids", pa.binary()), ("_part", pa.int32()), ("_row", pa.int64())])

            def table() -> pa.RecordBatch:
                places = np.arange(rows - len(found), rows)
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys, schema.field(0).type), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array([len(x) // 4 for x in found], pa.int64()), pa.array(found, pa.binary()),
                     pa.array(np.full(len(found), part, np.int32)), pa.array(places)], schema=schema)

            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                ends = range((len(ids) - 1) % length + 1, len(ids) + 1, length)
                for n, end in enumerate(ends):
                    start = end - length if n else 0
                    keys.append(key), pieces.append(n), starts.append(start), found.append(ids[start:end].tobytes())
                rows += len(ends)
                if len(found) >= 2000:
                    yield table()
                    for column in (keys, pieces, starts, found):
                        column.clear()
            if found:
                yield table()

    path = fresh_path(spark, "pieces")
    (docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
     .mapInArrow(cut_up, layout).write.option("compression", "zstd").parquet(path))
    pieces = spark.read.schema(layout).parquet(path)

    shorter = pieces.where(F.col("length") < length)
    groups = max(1, math.ceil(shorter.count() / group_items))
    items = shorter.select("_part", "_row", "length", F.pmod(F.xxhash64("_part", "_row"), F.lit(groups)).alias("_group"))

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_part", "ascending"), ("_row", "ascending")])
        lengths, group = table["length"].to_numpy(), table["_group"][0].as_py()
        filled = complete_bins(np.bincount(lengths, minlength=length + 1), length, nodes)
        sequence, offset = _place(lengths, filled)
        return pa.table({"_part": table["_part"], "_row": table["_row"], "sequence_id": (group << 40) + sequence,
                         "offset": offset})

    placed = items.groupBy("_group").applyInArrow(solve, "_part int, _row long, sequence_id long, offset long")
    own = (F.lit(_WHOLE) + F.shiftleft(F.col("_part").cast("long"), 40) + F.col("_row")).alias("sequence_id")
    columns = [F.col("_key").alias(id_col), "piece", "start", "length", "ids"]
    return (shorter.join(placed, ["_part", "_row"]).select(*columns, "sequence_id", "offset")
            .unionByName(pieces.where(F.col("length") == length).select(*columns, own, F.lit(0).cast("long").alias("offset"))))
