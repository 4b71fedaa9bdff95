"""Removing repeated passages: anchors route text to shards, FM-indexes find the repeats.

A window is ``length`` consecutive words. Its anchor is the run of ``ANCHOR`` words in it
with the smallest hash, so equal windows have equal anchors wherever they stand. Consecutive
windows with the anchor in the same place form a segment. An anchor seen once has no repeat. All
other segments go to a shard by their anchor, each different one once with its number of copies as
its weight. A shard holds an FM-index (a wavelet matrix of packed bits over the Burrows-Wheeler
transform) of its segments, bounded in words; the segments are streamed through backward search,
which gives the windows whose occurrences weigh two or more. These go back to every copy.

An anchor with more than ``MOST_SEGMENTS`` different segments (a line that stands in a third
of all documents) would make one shard too large. Its segments are divided again by longer
anchors, halfway to the window and then the whole window, which has one segment each; the shards of
those hold indexes like all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordinalis.llm.common import (cut_small, mix, run_hashes, size_at_most, small_batches, spare_names, word_hashes,
                                   worker_state, words_of)
from ordinalis.storage import cut

WINDOW = 35
ANCHOR = 8
MOST_SEGMENTS = 4096
SHARD_WORDS = 500_000

#: Documents whose ids may be broadcast to select texts; more are found by a join.
_BROADCAST_DOCS = 2_000_000

#: An odd base and its inverse modulo 2**64: hashes of stretches by differences of sums.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


def segments_of(words: np.ndarray, length: int, size: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(anchor, digest, first window, number of windows) of each segment of a document, by anchors of ``size`` words."""
    if len(words) < length:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    runs = run_hashes(words, size)
    inside = length - size + 1
    anchor = np.lib.stride_tricks.sliding_window_view(runs, inside).argmin(axis=1) + np.arange(len(words) - length + 1)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.concatenate([first, [len(anchor)]]))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words) * _powers(_BASE, len(words)), out=sums[1:])
    stretch = (sums[first + count - 1 + length] - sums[first]) * _powers(_INVERSE, len(words))[first]
    shape = (count * length + anchor[first] - first).astype(np.uint64)
    return runs[anchor[first]], mix(stretch + mix(shape)), first, count


class FmIndex:
    """Weighs the occurrences of word sequences of at most ``depth`` words; a segment counts ``weights`` times."""

    def __init__(self, segments: list[np.ndarray], depth: int, weights: np.ndarray | None = None):
        sizes = np.array([len(s) + 1 for s in segments])
        text = np.zeros(sizes.sum(), np.int64)  # symbol 0 ends each segment
        self.starts = np.cumsum(sizes) - sizes
        inside = np.ones(len(text), bool)
        inside[self.starts + sizes - 1] = False
        symbols, text[inside] = np.unique(np.concatenate(segments), return_inverse=True)
        text[inside] += 1
        self.text, self.size = text, len(text)
        order = self._suffix_order(depth)
        each = np.ones(len(segments), np.int64) if weights is None else weights
        self._mass = np.concatenate([[0], np.cumsum(np.repeat(each, sizes)[order])])  # weight of the suffixes before each
        self._build(text[order - 1], len(symbols) + 1)  # the word before each suffix, circularly

    def _suffix_order(self, depth: int) -> np.ndarray:
        """Suffixes sorted by at least their first ``depth`` words, by doubling; only those that are
        equal so far are sorted again. A rank is the first place of the suffixes that are equal."""
        order = np.argsort(self.text)
        places, key, rank, step = np.arange(self.size), self.text, np.zeros(self.size, np.int64), 1
        while True:
            ordered = key[order[places]] if step == 1 else key
            new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
            rank[order[places]] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
            places = places[~(new & np.concatenate([new[1:], [True]]))]
            if step >= depth or not len(places):
                return order
            some = order[places]
            after = np.where(some + step < self.size, rank[np.minimum(some + step, self.size - 1)] + 1, 0)
            key = rank[some] * (self.size + 2) + after
            by = np.argsort(key)
            order[places], key = some[by], key[by]
            step *= 2

    def _build(self, transform: np.ndarray, symbols: int) -> None:
        before = np.concatenate([[0], np.cumsum(np.bincount(transform, minlength=symbols))])[:symbols]
        self._levels = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bits = (transform >> shift & 1).astype(bool)
            padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
            padded[:len(bits)] = bits
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])[:-1]
            self._levels.append((shift, packed, ones, len(bits) - int(bits.sum())))
            transform = np.concatenate([transform[~bits], transform[bits]])
        every = np.arange(symbols)
        self._base = before - self._descend(every, np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, packed, ones, zeros in self._levels:
            word = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            rank = ones[word] + np.bitwise_count(packed[word] & low)
            at = np.where(symbol >> shift & 1, zeros + rank, at - rank)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the suffix intervals of the patterns with ``symbol`` put in front."""
        both = self._descend(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self._base[symbol]
        return base + both[:len(symbol)], base + both[len(symbol):]

    def repeated(self, which: np.ndarray, windows: np.ndarray, length: int) -> list[np.ndarray]:
        """For each of the segments ``which``, with so many windows, whether each occurs twice by weight.

        A pattern from window ``s`` to the word ``e`` is searched from its end. Found twice, all
        its windows are repeated. Found once only from ``p`` on, no window that holds p..e is.
        """
        found = [np.zeros(w, bool) for w in windows]
        base, last = self.starts[which], windows + length - 2
        s, e = np.zeros(len(which), np.int64), last.copy()
        unique = np.full(len(which), -1)  # the pattern from here to the last word occurs once
        at, low, high = e.copy(), np.zeros(len(which), np.int64), np.full(len(which), self.size)
        live = np.arange(len(which))
        while len(live):
            low[live], high[live] = self.extend(self.text[base[live] + at[live]], low[live], high[live])
            once = self._mass[high[live]] - self._mass[low[live]] < 2
            failed, done = live[once], live[~once & (at[live] == s[live])]
            for i in done:
                found[i][s[i]:e[i] - length + 2] = True
            s[done] = e[done] - length + 2
            short = failed[e[failed] == s[failed] + length - 1]
            whole = failed[e[failed] == last[failed]]
            unique[whole] = np.maximum(unique[whole], at[whole])
            longer = np.setdiff1d(failed, short, assume_unique=True)
            e[longer] = np.maximum(s[longer] + length - 1, np.minimum(at[longer] - 1, e[longer] - 1))
            s[short] = at[short] + 1
            moved = np.concatenate([done, short])
            e[moved] = np.where(s[moved] > unique[moved], last[moved], s[moved] + length - 1)
            again = np.concatenate([failed, done])
            at[live] -= 1
            at[again], low[again], high[again] = e[again], 0, self.size
            live = live[s[live] < windows[live]]
        return found


def _ranges(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def _mark_hot(segments: DataFrame, rows: int) -> DataFrame:
    """``segments`` (written; each different one once) with ``hot``: too many share its anchor for one shard."""
    hot = cut_small(segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_SEGMENTS)
                    .select("anchor", F.lit(True).alias("hot")), "hot-anchors", rows)
    return segments.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))


def _searched(parts: DataFrame, total: int, length: int, shard_words: int) -> DataFrame:
    """(anchor, digest, spans) of the segments with repeated windows, from the index of their shard."""

    def search(shard: pa.Table) -> pa.Table:
        segments = [np.frombuffer(w, "<u8") for w in shard["words"].to_pylist()]
        windows = np.array([len(s) - length + 1 for s in segments])
        index = FmIndex(segments, max(map(len, segments)), shard["copies"].to_numpy())
        spans = [[{"a": a, "b": b} for a, b in _ranges(mask)] for mask in index.repeated(np.arange(len(segments)), windows, length)]
        column = pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
        return shard.select(["anchor", "digest"]).append_column("spans", column).filter(pa.array([len(s) > 0 for s in spans]))

    shards = max(1, math.ceil(total / shard_words))
    return (parts.select("anchor", "digest", "copies", "words", F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("_shard"))
            .groupBy("_shard").applyInArrow(search, "anchor long, digest long, spans array<struct<a: int, b: int>>"))


def _divided(parts: DataFrame, length: int, size: int, shard_words: int) -> DataFrame:
    """The same of segments of hot anchors (written), divided by anchors of ``size`` words first."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                some = batch.slice(start, 100)
                columns, sizes, words = [], [], []
                for segment in some.column(3):
                    own = np.frombuffer(segment.as_py(), "<u8")
                    columns.append(segments_of(own, length, size))
                    sizes.append(len(columns[-1][0]))
                    words += [own[a:a + n + length - 1].tobytes() for a, n in zip(*columns[-1][2:])]
                of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                anchor, digest, first, _ = (np.concatenate(c) for c in zip(*columns))
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(of) for c in some.columns[:3]), pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64)),
                     pa.array(first.astype(np.int32)), pa.array(words, pa.binary())],
                    names=["of_anchor", "of_digest", "copies", "anchor", "digest", "at", "words"])

    pieces = cut(parts.select("anchor", "digest", "copies", "words").mapInArrow(
        split, "of_anchor long, of_digest long, copies long, anchor long, digest long, at int, words binary"), "divided-segments")
    rows = pieces.count()
    often = cut_small(pieces.groupBy("anchor").agg(F.sum("copies").alias("n")).where("n > 1").select("anchor"), "divided-anchors", rows)
    own = cut_small(pieces.join(often, "anchor", "left_semi").groupBy("anchor", "digest")
                    .agg(F.sum("copies").alias("copies"), F.first("words").alias("words")), "divided-words", rows)
    marked = _mark_hot(own, rows)
    found = cut(_matches(marked, *_extent(marked, F.octet_length("words") / 8), length, size, shard_words), "divided-matches")
    shift = lambda w: F.struct((w["a"] + F.col("at")).alias("a"), (w["b"] + F.col("at")).alias("b"))
    return (pieces.select("of_anchor", "of_digest", "anchor", "digest", "at").join(found, ["anchor", "digest"])
            .groupBy(F.col("of_anchor").alias("anchor"), F.col("of_digest").alias("digest"))
            .agg(F.flatten(F.collect_list(F.transform("spans", shift))).alias("spans")))  # of the windows of one segment


def _extent(marked: DataFrame, words: Column) -> tuple[int, bool]:
    """(words of the segments that aren't hot, whether there are hot ones)"""
    row = marked.agg(F.sum(F.when(~F.col("hot"), words)).alias("words"), F.max("hot").alias("hot")).first()
    return int(row.words or 0), bool(row.hot)


def _matches(parts: DataFrame, total: int, any_hot: bool, length: int, size: int, shard_words: int) -> DataFrame:
    """(anchor, digest, spans) of the segments ``parts`` (anchor, digest, copies, words, hot) that were made by anchors of
    ``size`` words: ranges of windows, counted from the segment's first, that occur twice."""
    found = _searched(parts.where(~F.col("hot")), total, length, shard_words)
    if not any_hot:
        return found
    longer = length if size > ANCHOR else (ANCHOR + length + 1) // 2  # two segments with one whole window are equal
    return found.unionByName(_divided(parts.where("hot"), length, longer, shard_words))


def repeated_windows(docs: DataFrame, length: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(_id, _key, spans): per document with repeats the sets of first and last-but-one window.

    ``docs`` has _id, _key (tells rows with equal ids and different texts apart) and _text.
    """

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("anchors", dict)  # nothing is kept, but what an operator before kept goes
        for batch in batches:
            columns, sizes = [], []
            for text in batch.column(2):
                columns.append(segments_of(word_hashes(text.as_py()), length))
                sizes.append(len(columns[-1][0]))
            of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            anchor, digest, first, count = (np.concatenate(c) for c in zip(*columns))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), batch.column(1).take(of), pa.array(anchor.view(np.int64)),
                 pa.array(digest.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))],
                names=["_id", "_key", "anchor", "digest", "first", "windows"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of each wanted segment."""
        for batch in batches:
            rows = {"anchor": [], "digest": [], "copies": [], "hot": [], "words": []}
            for text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                words = word_hashes(text)
                for w in wanted:
                    rows["words"].append(words[w["first"]:w["first"] + w["windows"] + length - 1].tobytes())
                    for name in ("anchor", "digest", "copies", "hot"):
                        rows[name].append(w[name])
            types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows.values(), types)], names=list(rows))

    id_type = dict(docs.dtypes)["_id"]
    seen = cut(docs.select("_id", "_key", "_text").mapInArrow(
        anchors, f"_id {id_type}, _key long, anchor long, digest long, first int, windows int"), "anchors")
    rows = seen.count()
    often = cut_small(seen.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "repeated-anchors", rows)
    shared = cut_small(seen.join(often, "anchor", "left_semi"), "shared-anchors", rows)
    rows = shared.count()
    one = F.min(F.struct("_id", "_key", "first", "windows")).alias("one")
    distinct = cut_small(shared.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("copies"), one)
                         .select("anchor", "digest", "copies", "one.*"), "distinct-segments", rows)
    wanted = cut_small(_mark_hot(distinct, rows).groupBy("_id", "_key").agg(F.collect_list(
        F.struct("anchor", "digest", "first", "windows", "copies", "hot")).alias("wanted")), "wanted-segments", rows)
    total, any_hot = _extent(wanted.select(F.inline("wanted")), F.col("windows") + length - 1)
    texts = docs.select("_id", "_key", "_text")
    if size_at_most(wanted, _BROADCAST_DOCS):  # only the texts that are wanted are shuffled
        texts = texts.join(F.broadcast(wanted.select("_key")), "_key", "left_semi")
    texts = texts.dropDuplicates(["_id", "_key"])
    parts = (texts.join(wanted, texts["_id"].eqNullSafe(wanted["_id"]) & (texts["_key"] == wanted["_key"]))
             .select("_text", "wanted").mapInArrow(take, "anchor long, digest long, copies long, hot boolean, words binary"))
    if any_hot:  # they are read twice
        parts = cut(parts, "segment-words")
    found = cut(_matches(parts, total, any_hot, length, ANCHOR, shard_words), "matches")
    spans = shared.join(found, ["anchor", "digest"]).select("_id", "_key", "first", F.inline("spans"))
    return cut_small(spans.groupBy("_id", "_key").agg(F.collect_set(F.struct(
        (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))).alias("spans")), "repeated-windows", rows)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = WINDOW) -> DataFrame:
    """``docs`` with kept_text (kept words joined by one space), n_words, n_removed and removed_spans
    (array of first and one past the last removed word).

    Every word goes that lies in a window of ``length`` words whose sequence starts anywhere
    else too, all copies included; windows are judged on the input. A null text has no words.
    Repeated rows are separate documents, so their windows repeat. Columns of these names
    are replaced; an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    # the id may be null, and rows may share an id: the hash of both tells texts apart
    own, words, key, of, its, some, made = spare_names(docs, "_id", "_text", "_key", "_of", "_its", "_spans", "_out")
    rows = docs.withColumns({own: F.col(id_col), words: F.col(text_col), key: F.xxhash64(F.col(id_col), F.col(text_col))})
    spans = repeated_windows(rows.select(F.col(own).alias("_id"), F.col(key).alias("_key"), F.col(words).alias("_text")), length)

    @F.arrow_udf("kept_text string, n_words long, n_removed long, removed_spans array<struct<start: int, end: int>>")
    def apply(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, some in zip(texts, found):
            words, some = words_of(text.as_py()), some.as_py() or []
            gone = np.zeros(len(words), bool)
            for one in some:
                gone[one["a"]:one["b"] + length - 1] = True
            stretches = list(_ranges(gone))
            kept, at = [], 0
            for a, b in stretches:
                kept += words[at:a]
                at = b
            kept += words[at:]
            out.append({"kept_text": " ".join(kept), "n_words": len(words), "n_removed": len(words) - len(kept),
                        "removed_spans": [{"start": a, "end": b} for a, b in stretches]})
        return pa.array(out, pa.struct([("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                                        ("removed_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))

    marked = rows.join(spans.select(F.col("_id").alias(of), F.col("_key").alias(its), F.col("spans").alias(some)),
                       F.col(own).eqNullSafe(F.col(of)) & (F.col(key) == F.col(its)), "left")
    names = ("kept_text", "n_words", "n_removed", "removed_spans")
    done = marked.withColumn(made, apply(words, some))
    return done.withColumns({n: F.col(made)[n] for n in names}).drop(own, words, key, of, its, some, made)
