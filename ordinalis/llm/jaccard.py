"""N-gram Jaccard join: exact links between similar texts by T-occurrence search.

Texts become sets of hashed word shingles; texts with equal sets are one class. Sets are
sorted by hash. Two sets that are similar enough share shingles among the first of each,
their prefixes, and not only one: at least ``shared_at_least``.
Prefix shingles that only one class has are dropped, then classes with too few left, and what
remains makes candidates:

- lists of at most ``SHORT_LIST`` classes give pairs, which must share enough prefix
  shingles (those on longer lists may make up what is missing);
- longer lists tie together those of their classes that could share enough by long lists alone.

The connected parts of the candidates are blocks: similar classes are never in different
ones. In a block every set is searched in an inverted index of the others by DivideSkip: its
short lists are merged by a heap, the long ones only probed by binary search for the sets
found so far, and what reaches the required overlap is linked. Sets already connected aren't
compared again. A block that is too large for one task is cut into tiles, and each pair of
tiles is one task. A shingle that a third of all texts have (a common line) is a long list that
hardly any class is tied by, as a line is a small part of what similar texts share.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordinalis.llm.common import WORD_PATTERN, cut_small, run_hashes, size_at_most, small_batches, spare_names, word_hashes, worker_state
from ordinalis.llm.graph import components
from ordinalis.storage import cut

SHINGLE = 5
SHORT_LIST = 64
#: Short texts have prefixes of at least so many shingles, or all they have.
LEAST_PREFIX = 48
#: The bound on shared prefix shingles fails for a similar pair with at most exp(-RARE) = 1e-15.
RARE = 34.5
#: A tile holds about so many sets and shingles.
TILE_SETS, TILE_SHINGLES = 8192, 4_000_000
#: Rows that may be broadcast to select others; more are joined by a shuffle.
_BROADCAST_ROWS = 2_000_000


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct runs of k words; of the whole text where it has fewer."""
    words = word_hashes(text, lower=True)
    return np.unique(run_hashes(words, min(k, len(words)))) if len(words) else words


def class_of(tokens: np.ndarray) -> int:
    """64 bits that stand for the set."""
    import xxhash

    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def prefix_length(n: int) -> int:
    """How many first shingles of a set are listed: enough to share one with any similar set."""
    return max(n - (3 * n + 3) // 4 + 1, min(n, LEAST_PREFIX))


def shared_at_least(n: Column) -> Column:
    """Of its prefix, how many shingles a set of ``n`` shares with the prefix of a similar set, if
    its own prefix ends first.

    A similar set lacks at most a quarter of the n, so at most that many of the prefix. And
    as the order is by hash, the prefix is a random part of the set: that fewer are shared than
    three quarters by sqrt(RARE / 2 * length) has probability exp(-RARE) at most (Hoeffding).
    """
    length = F.greatest(n - F.floor((3 * n + 3) / 4) + 1, F.least(n, F.lit(LEAST_PREFIX)))
    by_chance = F.floor(0.75 * length - F.sqrt(RARE / 2 * length))
    return F.greatest(F.lit(1), length - F.floor(n / 4), by_chance).cast("long")


def least_shared(n: Column) -> Column:
    """The least of ``shared_at_least`` over all sizes that a similar set may have. It rises up to
    LEAST_PREFIX, falls up to four times that, and rises again."""
    low, high, dip = F.ceil(3 * n / 4), F.floor(4 * n / 3), F.lit(4 * LEAST_PREFIX)
    inside = F.when((low < dip) & (high > dip), shared_at_least(dip))
    return F.least(shared_at_least(low), shared_at_least(n), shared_at_least(high), inside)


_ROWS = ["_id", "_key", "n", "class", "token"]


def describe(docs: DataFrame, k: int) -> DataFrame:
    """(_id, _key, n, class, token): one row per text without token, and for each set a row per
    prefix shingle without _id and _key, once a task for copies that it has seen.

    Equal sets have equal classes; an empty set has class null.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("shingles", dict)  # nothing is kept, but what an operator before kept goes
        seen: set[int] = set()
        for batch in batches:
            sizes, classes, new, listed = [], [], [], []
            for text in batch.column(2):
                tokens = shingle_set(text.as_py(), k)
                sizes.append(len(tokens))
                classes.append(name := class_of(tokens) if len(tokens) else None)
                if name is not None and name not in seen:
                    if len(seen) < 200_000:
                        seen.add(name)
                    new.append((name, len(tokens)))
                    listed.append(tokens[:prefix_length(len(tokens))])
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                                              pa.array(classes, pa.int64()), none], names=_ROWS)
            lengths = [len(x) for x in listed]
            token = np.concatenate([*listed, np.zeros(0, np.uint64)]).view(np.int64)
            name, n = (np.repeat(np.array([x[i] for x in new], np.int64), lengths) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(token), batch.schema.field(0).type), pa.nulls(len(token), pa.int64()),
                                              pa.array(n), pa.array(name), pa.array(token)], names=_ROWS)

    id_type = dict(docs.dtypes)["_id"]
    return docs.select("_id", "_key", "_text").mapInArrow(rows, f"_id {id_type}, _key long, n long, class long, token long")


def _peeled(lists: DataFrame, rows: int) -> DataFrame:
    """Without classes that share too few prefix shingles to have a partner, and without shingles
    that only one of the others has."""
    kept = lists.groupBy("class").agg(F.count(F.lit(1)).alias("_shared"), F.first("n").alias("_n"))
    kept = kept.where(F.col("_shared") >= least_shared(F.col("_n"))).select("class")
    rest = cut_small(lists.join(kept, "class"), "peeled-lists", rows)
    often = cut_small(rest.groupBy("token").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1").select("token"), "shared-shingles", rows)
    return cut_small(rest.join(often, "token"), "prefix-lists", rows)


def candidate_edges(postings: DataFrame) -> DataFrame:
    """(a, b): pairs of classes that may be similar, or that tie a block together.

    ``postings`` (token, class, n) may hold a row more than once.
    """
    shared = postings.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high").select("token")
    rows = postings.count()
    lists = cut_small(postings.join(cut_small(shared, "shared-shingles", rows), "token").distinct(), "prefix-lists", rows)
    for _ in range(2):
        rows = lists.count()
        lists = _peeled(lists, rows)
    sizes = cut_small(lists.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "list-sizes", rows)
    short = lists.join(sizes.where(F.col("df") <= SHORT_LIST).select("token"), "token")
    long = cut_small(lists.join(sizes.where(F.col("df") > SHORT_LIST).select("token"), "token"), "long-lists", rows)
    spare = cut_small(long.groupBy("class").agg(F.count(F.lit(1)).alias("spare"), F.first("n").alias("n")), "long-shared", rows)

    left = short.select("token", F.col("class").alias("a"), F.col("n").alias("na"))
    right = short.select("token", F.col("class").alias("b"), F.col("n").alias("nb"))
    alike = (4 * F.least("na", "nb") >= 3 * F.greatest("na", "nb")) & (F.col("a") < F.col("b"))
    pairs = (left.join(right, "token").where(alike).groupBy("a", "b")
             .agg(F.count(F.lit(1)).alias("common"), F.first("na").alias("na"), F.first("nb").alias("nb")))
    needed = F.least(shared_at_least(F.col("na")), shared_at_least(F.col("nb")))
    enough = F.col("common") + F.least(F.coalesce("sa", F.lit(0)), F.coalesce("sb", F.lit(0))) >= needed
    pairs = (pairs.join(spare.select(F.col("class").alias("a"), F.col("spare").alias("sa")), "a", "left")
             .join(spare.select(F.col("class").alias("b"), F.col("spare").alias("sb")), "b", "left").where(enough))

    able = long.join(spare.where(F.col("spare") >= least_shared(F.col("n"))).select("class"), "class").select("token", "class")
    hubs = cut_small(able.groupBy("token").agg(F.min("class").alias("hub")), "hubs", rows)
    tied = able.join(hubs, "token").where("class != hub").select(F.col("hub").alias("a"), F.col("class").alias("b")).distinct()
    # a list of SHORT_LIST classes leaves at most half as many pairs for each of them
    return cut_small(pairs.select("a", "b").unionByName(tied), "candidates", rows)


def divide_skip(queries: list[np.ndarray], indexed: list[np.ndarray], same: bool) -> list[tuple[int, int]]:
    """Links (query, indexed) that connect all similar sets, without those already connected.

    With ``same`` the two lists are one, and each pair is looked at once.
    """
    sizes = np.array([len(s) for s in indexed])
    tokens, holder = np.concatenate(indexed), np.repeat(np.arange(len(indexed)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, holder = tokens[order], holder[order]
    names, start = np.unique(tokens, return_index=True)
    end = np.append(start[1:], len(tokens))
    connected, links = np.arange(len(indexed) + (0 if same else len(queries))), []
    for q, own in enumerate(queries):
        me = q if same else len(indexed) + q
        at = np.minimum(np.searchsorted(names, own), len(names) - 1)
        at = at[names[at] == own]
        at = at[np.argsort(end[at] - start[at], kind="stable")]
        least = (3 * len(own) + 3) // 4  # the overlap any similar set must have
        if len(at) < least:
            continue
        longest = int(end[at[-1]] - start[at[-1]])
        skipped = min(least - 1, int(least / (0.01 * np.log2(longest + 1) + 1)))
        near = (4 * np.minimum(sizes, len(own)) >= 3 * np.maximum(sizes, len(own)))
        short = []
        for i in at[:len(at) - skipped]:
            some = holder[start[i]:end[i]]
            short.append(some[near[some] & (some < q)] if same else some[near[some]])
        probes = [holder[start[i]:end[i]] for i in at[len(at) - skipped:]]
        last = -1
        while last is not None:  # after a link, whatever is connected now leaves the lists
            short = [some[(some > last) & (connected[some] != connected[me])] for some in short]
            last = None
            for other, times in groupby(heapq.merge(*(some.tolist() for some in short))):
                common = sum(1 for _ in times)
                if common < least - skipped:
                    continue
                needed = -(-3 * (len(own) + int(sizes[other])) // 7)
                for left, some in zip(range(len(probes), 0, -1), probes):
                    if common >= needed or common + left < needed:
                        break
                    place = bisect_left(some, other)
                    common += place < len(some) and some[place] == other
                if common >= needed:
                    connected[connected == connected[other]] = connected[me]
                    links.append((q, other))
                    last = other
                    break
    return links


def _search(table: pa.Table, i: int, j: int) -> pa.Table:
    """Links within a block (i = j), or between the sets of its tiles i and j."""
    classes = table["class"].to_numpy()
    sets = [np.frombuffer(t, "<u8") for t in table["tokens"].to_pylist()]
    tile = table["tile"].to_numpy()
    left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    links = divide_skip([sets[p] for p in left], [sets[p] for p in right], i == j) if len(left) and len(right) else []
    return pa.table({"a": pa.array([classes[left[q]] for q, _ in links], pa.int64()),
                     "b": pa.array([classes[right[o]] for _, o in links], pa.int64())})


def class_links(docs: DataFrame, postings: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(a, b) between classes, enough of them to connect whatever is similar.

    ``classes`` has class, n, and of one text with that set _id and _key.
    """
    blocks = components(candidate_edges(postings))  # node, component
    sets_in_blocks = blocks.count()
    members = cut_small(blocks.withColumnRenamed("node", "class").join(classes, "class"), "block-members", sets_in_blocks)
    size = cut_small(members.groupBy("component").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles")),
                     "block-sizes", sets_in_blocks)
    tiles = F.greatest(F.ceil(F.col("sets") / TILE_SETS), F.ceil(F.col("shingles") / TILE_SHINGLES)).cast("int")
    placed = members.join(size.select("component", tiles.alias("tiles")), "component")
    wanted = cut_small(placed.select("_id", "_key", "class", "component", "tiles",
                                     F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int").alias("tile")),
                       "wanted-sets", sets_in_blocks)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [shingle_set(t.as_py(), k).tobytes() for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("class", "component", "tiles", "tile")),
                                              pa.array(tokens, pa.binary())], names=["class", "component", "tiles", "tile", "tokens"])

    texts = docs.select("_id", "_key", "_text")
    if size_at_most(wanted, _BROADCAST_ROWS):  # only the texts that are wanted are shuffled
        texts = texts.join(F.broadcast(wanted.select("_key").distinct()), "_key", "left_semi")
    texts = texts.dropDuplicates(["_id", "_key"])
    full = (texts.join(wanted, texts["_id"].eqNullSafe(wanted["_id"]) & (texts["_key"] == wanted["_key"]))
            .select("class", "component", "tiles", "tile", "_text")
            .mapInArrow(sets, "class long, component long, tiles int, tile int, tokens binary"))
    # a set of tile t takes part in the tasks (t, j) and (i, t)
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    tasks = (full.withColumn("_other", others)
             .withColumns({"i": F.least("tile", "_other"), "j": F.greatest("tile", "_other")}).drop("_other", "tiles"))
    return tasks.groupBy("component", "i", "j").applyInArrow(
        lambda key, table: _search(table, key[1].as_py(), key[2].as_py()), "a long, b long")


def similar_groups(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(_id, _key, n_shingles, component_id, group) for every row of ``docs``; _key is the hash of id
    and text, group is null for a text without shingles."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), _key(id_col, text_col))
    described = cut(describe(rows, k), "shingle-sets")
    texts = described.where("token is null").select("_id", "_key", F.col("n").alias("n_shingles"), "class")
    rows_in_all = texts.count()
    classes = cut_small(texts.where("class is not null").groupBy("class").agg(
        F.min("_id").alias("smallest"), F.min(F.struct("_id", "_key")).alias("one"), F.first("n_shingles").alias("n"))
        .select("class", "smallest", "n", "one.*"), "shingle-classes", rows_in_all)
    postings = described.where("token is not null").select("token", "class", "n")
    links = cut(class_links(rows, postings, classes.select("class", "n", "_id", "_key"), k), "links")
    reached = components(links).withColumnRenamed("node", "class")
    groups = classes.join(reached, "class", "left").withColumn("group", F.coalesce("component", "class"))
    lowest = cut_small(groups.groupBy("group").agg(F.min("smallest").alias("component_id")), "lowest-ids", rows_in_all)
    of_class = cut_small(groups.select("class", "group").join(lowest, "group"), "class-groups", rows_in_all)
    own = F.when(F.col("class").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return cut_small(texts.join(of_class, "class", "left").withColumn("component_id", own)
                     .select("_id", "_key", "n_shingles", "component_id", "group"), "text-groups", rows_in_all)


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key")


def similar_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """(id_col, n_shingles, component_id), a row per text; component_id is the smallest id
    reachable by links.

    Two texts link when their shingle sets have a Jaccard similarity of 0.75 or more. Words
    are lower-cased A-Z and split at ASCII white space; a null text, or one without words, has
    no shingles, links with nothing and is its own component. Repeated rows are equal texts.
    Null ids are reachable but never the smallest. Other columns are dropped; an empty table
    gives an empty result.
    """
    found = similar_groups(docs, id_col, text_col, k)
    return found.select(F.col("_id").alias(id_col), "n_shingles", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """``docs`` with one text of each component, that with the smallest id (a null one last); texts
    without shingles, null ones too, all stay. Of rows equal in id and text that stay, one is kept
    if they have shingles. Columns may have any names; an empty table stays empty.
    """
    found = similar_groups(docs, id_col, text_col, k)
    first = F.min(F.struct(F.col("_id").isNull().alias("unknown"), "_id", "_key")).alias("one")
    kept = found.where("group is not null").groupBy("group").agg(first).select("one._id", "one._key")
    own, key, of, its = spare_names(docs, "_id", "_key", "_of", "_its")
    kept = cut(kept.select(F.col("_id").alias(of), F.col("_key").alias(its)), "kept-texts")
    rows = docs.withColumns({own: F.col(id_col), key: _key(id_col, text_col)})
    one = (rows.join(kept, F.col(own).eqNullSafe(F.col(of)) & (F.col(key) == F.col(its)))
           .dropDuplicates([own, key]).drop(own, key, of, its))
    return one.unionByName(docs.where(~F.coalesce(F.col(text_col).rlike(WORD_PATTERN), F.lit(False))))
