"""Packing documents into sequences of a fixed length: bounded-space online packing.

Each partition keeps at most ``open_windows`` unfinished sequences. A document's tokens fill
whole sequences first; the rest goes into the open window it fits best. When it fits none
and no further window may be opened, the fullest window is topped up with the head of the
piece and emitted, so it has no padding, and the rest is placed again. What is left open at
the end of the partitions carries its ids along and is merged in small groups of partitions
by the same rule; a group's very last sequences are cut to powers of two, the lengths that
need no padding.

The placed pieces, ids included, are written once into the shared folder: a lost executor
cannot make the merged and the unmerged part disagree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ordinalis.llm.common import small_batches
from ordinalis.storage import fresh_path

#: Partitions whose leftovers are merged together: at most so many times ``open_windows`` windows.
MERGED_PARTITIONS = 8

_MERGED = 1 << 62


class _Windows:
    """Unfinished sequences; finished ones are handed to ``emit(pieces)``."""

    def __init__(self, length: int, most: int, emit: Callable[[list], None]):
        self.length, self.most, self.emit, self.open = length, most, emit, []

    def place(self, key, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.length:
            self.emit([(key, start, ids[:self.length], total)])
            start, ids = start + self.length, ids[self.length:]
        while len(ids):
            fitting = [w for w in self.open if self.length - w[0] >= len(ids)]
            if fitting:
                window = max(fitting, key=lambda w: w[0])
            elif len(self.open) < self.most:
                self.open.append(window := [0, []])
            else:
                window = max(self.open, key=lambda w: w[0])
            room = min(self.length - window[0], len(ids))
            window[1].append((key, start, ids[:room], total))
            window[0] += room
            start, ids = start + room, ids[room:]
            if window[0] == self.length:
                self.open = [w for w in self.open if w is not window]
                self.emit(window[1])

    def close(self) -> None:
        """Emit what is open: whole sequences, then lengths that are powers of two."""
        rest = [piece for w in self.open for piece in w[1]]
        left = sum(len(p[2]) for p in rest)
        self.open = []
        while left:
            size = min(self.length, 1 << (left.bit_length() - 1))
            left, filled, taken = left - size, 0, []
            while filled < size:
                key, start, ids, total = rest.pop(0)
                room = min(size - filled, len(ids))
                taken.append((key, start, ids[:room], total))
                filled += room
                if room < len(ids):
                    rest.insert(0, (key, start + room, ids[room:], total))
            self.emit(taken)


def _rows(pieces: list, group: int, sequence: int | None, window: int) -> list[dict]:
    rows, offset = [], 0
    for key, start, ids, total in pieces:
        rows.append({"_key": key, "start": start, "length": len(ids), "ids": ids.tobytes(), "doc_tokens": total,
                     "_group": group, "_window": window, "sequence_id": sequence, "offset": offset})
        offset += len(ids)
    return rows


def pack(docs: DataFrame, encode: Callable[[str | None], np.ndarray], end_id: int, *, id_col: str = "doc_id",
         text_col: str = "text", length: int = 4096, open_windows: int = 8) -> DataFrame:
    """(id_col, start, length, ids, doc_tokens, sequence_id, offset), one row per piece.

    ``encode`` gives the ids of a text; ``end_id`` follows every document, so a null or
    empty text is one piece of one token. ``ids`` is binary: little-endian unsigned 32-bit
    numbers. ``start`` counts the ids of the document before the piece, ``offset`` those of
    the sequence. Equal rows, ids included, are separate documents; a null id is kept; other
    columns are dropped; an empty table gives no pieces. ``length`` must be a power of two.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    small_batches(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_col]
    layout = (f"_key {id_type}, start long, length long, ids binary, doc_tokens long, _group int, _window int, "
              "sequence_id long, offset long")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, sequences = TaskContext.get().partitionId(), [], 0
        group = part // MERGED_PARTITIONS

        def emit(pieces):
            nonlocal sequences
            done.extend(_rows(pieces, group, (part << 32) + sequences, 0))
            sequences += 1

        windows = _Windows(length, open_windows, emit)
        schema = None
        for batch in batches:
            schema = schema or _piece_schema(batch.schema.field(0).type)
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                windows.place(key, 0, ids, len(ids))
                if len(done) >= 2000:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done.clear()
        left = [r for n, w in enumerate(windows.open) for r in _rows(w[1], group, None, part * open_windows + n)]
        if schema:
            yield pa.RecordBatch.from_pylist(done + left, schema)

    def merge(table: pa.Table) -> pa.Table:
        pieces = table.sort_by([("_window", "ascending"), ("offset", "ascending")]).to_pylist()
        done, sequences = [], 0
        group = pieces[0]["_group"]

        def emit(taken):
            nonlocal sequences
            done.extend(_rows(taken, group, _MERGED + (group << 32) + sequences, 0))
            sequences += 1

        windows = _Windows(length, open_windows, emit)
        for p in pieces:
            windows.place(p["_key"], p["start"], np.frombuffer(p["ids"], "<u4"), p["doc_tokens"])
        windows.close()
        return pa.Table.from_pylist(done, _piece_schema(table.schema.field("_key").type))

    path = fresh_path(docs.sparkSession, "packed")
    (docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
     .mapInArrow(fill, layout).write.option("compression", "zstd").parquet(path))
    placed = docs.sparkSession.read.schema(layout).parquet(path)
    whole, left = placed.where(F.col("sequence_id").isNotNull()), placed.where(F.col("sequence_id").isNull())
    merged = left.groupBy("_group").applyInArrow(merge, layout)
    return whole.unionByName(merged).select(F.col("_key").alias(id_col), "start", "length", "ids", "doc_tokens",
                                            "sequence_id", "offset")


def _piece_schema(key: pa.DataType) -> pa.Schema:
    return pa.schema([("_key", key), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                      ("doc_tokens", pa.int64()), ("_group", pa.int32()), ("_window", pa.int32()),
                      ("sequence_id", pa.int64()), ("offset", pa.int64())])
