import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ordinalis.llm import byteranks, completion, queries


def letters(text):
    return np.array([ord(c) for c in text or ""], "<u4")


def fewest(sizes, capacity):
    """By trying every sequence for every piece."""
    sizes, best = sorted(sizes, reverse=True), len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for at in {room: at for at, room in enumerate(rooms) if room >= sizes[i]}.values():
            rooms[at] -= sizes[i]
            go(i + 1, rooms)
            rooms[at] += sizes[i]
        go(i + 1, rooms + [capacity - sizes[i]])

    go(0, [])
    return best


def used_up(filled, capacity):
    total = Counter()
    for filling, times in filled:
        assert times > 0 and sum(s * n for s, n in filling) <= capacity
        total.update({s: n * times for s, n in filling})
    return total


def plain_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fitting = [at for at, room in enumerate(rooms) if room >= s]
        if fitting:
            rooms[min(fitting, key=lambda at: rooms[at])] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


def test_as_few_sequences_as_there_can_be():
    rng, better = random.Random(7), 0
    for _ in range(400):
        capacity = rng.choice([10, 30, 100])
        sizes = [rng.randint(rng.choice([1, capacity // 5]), rng.choice([capacity // 2, capacity - 1])) for _ in range(rng.randint(1, 12))]
        counts = np.bincount(sizes, minlength=capacity + 1)
        filled = completion.complete_bins(counts, capacity)
        assert used_up(filled, capacity) == Counter(sizes)
        made, best = sum(n for _, n in filled), fewest(sizes, capacity)
        assert completion.least_bins(counts, capacity) <= best == made
        by_best_fit = sum(n for _, n in completion.best_fit(counts, capacity))
        assert by_best_fit == plain_best_fit(sizes, capacity) >= made
        better += made < by_best_fit
    assert better


def test_many_pieces_never_worse_than_best_fit():
    rng = np.random.default_rng(1)
    for low, high, n in [(300, 700, 50_000), (400, 1000, 50_000), (1, 2048, 50_000), (1, 9, 50_000), (1025, 2047, 500)]:
        sizes = rng.integers(low, high, n)
        counts = np.bincount(sizes, minlength=2049)
        filled = completion.complete_bins(counts, 2048, nodes=100)
        assert used_up(filled, 2048) == Counter(sizes.tolist())
        made = sum(t for _, t in filled)
        assert completion.least_bins(counts, 2048) <= made <= sum(t for _, t in completion.best_fit(counts, 2048))
        if (low, high) == (300, 700):
            assert made < plain_best_fit_count(counts) * 0.98


def plain_best_fit_count(counts):
    return sum(t for _, t in completion.best_fit(counts, 2048))


def test_dominated_fillings():
    def dominated(filling, waste, counts):
        return completion._dominated(filling, waste, sum(1 << s for s in counts), counts)

    assert dominated(((3, 1), (2, 1)), 0, {2: 1, 3: 1, 5: 1})  # 5 takes the place of both
    assert dominated(((3, 1),), 1, {3: 1, 4: 1})
    assert not dominated(((3, 1),), 0, {3: 1, 4: 1})
    assert not dominated(((3, 1), (2, 1)), 0, {2: 4, 3: 4})
    assert not dominated(((4, 1), (2, 1)), 1, {2: 1, 4: 1})


def checked(rows, wanted, length):
    """wanted: id -> list of id lists (rows with equal ids). How many sequences there are."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == wanted.keys()
    for key, lists in wanted.items():
        pieces = Counter((r.piece, r.start, bytes(r.ids)) for r in by_doc[key])
        expected = Counter()
        for ids in lists:
            data, ends = np.array(ids, "<u4"), [*range((len(ids) - 1) % length + 1, len(ids) + 1, length)]
            starts = [0, *ends[:-1]]
            expected.update((n, a, data[a:b].tobytes()) for n, (a, b) in enumerate(zip(starts, ends)))
        assert pieces == expected
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length == len(r.ids) // 4
            at += r.length
        assert at <= length
    return len(by_sequence)


@pytest.mark.parametrize("partitions", [1, 12])
def test_every_document_is_packed_whole(spark, partitions):
    rng = random.Random(4)
    texts = [None, "", "", "x" * 1000, "y" * 31, "y" * 63, "z" * 32, *("".join(rng.choices("abcd", k=rng.randint(0, 60))) for _ in range(300))]
    rows = [(i, t, "clash", 1, 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _part string, _row int, ids int").repartition(partitions)
    made = completion.pack_whole(docs, letters, 2, length=32)
    assert made.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    wanted = {i: [[*letters(t).tolist(), 2]] for i, t in enumerate(texts)}
    n = checked(made.collect(), wanted, 32)
    total = sum(len(ids) for lists in wanted.values() for ids in lists)
    assert -(-total // 32) <= n <= -(-total // 32) + 1


def test_groups_do_not_mix(spark):
    texts = ["a" * (i % 30) for i in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = completion.pack_whole(docs, letters, 2, length=32, group_items=60).collect()
    checked(rows, {i: [[*letters(t).tolist(), 2]] for i, t in enumerate(texts)}, 32)
    assert len({r.sequence_id >> 40 for r in rows}) > 5


def test_repeated_rows_null_ids_and_the_empty_table(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (None, "x"), (None, None), (2, "longer than that")], "doc_id long, text string")
    rows = completion.pack_whole(docs, letters, 2, length=8).collect()
    checked(rows, {1: [[*b"same", 2]] * 2, None: [[ord("x"), 2], [2]], 2: [[*b"longer than that", 2]]}, 8)
    assert completion.pack_whole(docs.limit(0), letters, 2).collect() == []


def test_only_places_and_lengths_are_grouped(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = completion.pack_whole(docs, letters, 2, length=8).select("doc_id", "sequence_id")._jdf.queryExecution().executedPlan().toString()
    assert "ids#" not in plan.split("FlatMapGroupsInArrow")[1].split("ReadSchema")[0]


def test_query_over_all_documents(spark, sf_dir):
    library = Tokenizer.from_file(queries.public_tokenizers.path(queries.BYTE_VOCABULARY))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in queries.op11_bin_completion(spark, sf_dir).collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == texts.keys()
    total = 0
    for key, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        at = 0
        for n, r in enumerate(sorted(by_doc[key], key=lambda r: r.start)):
            assert (r.piece, r.start, r.ids_crc32) == (n, at, zlib.crc32(ids[at:at + r.length].tobytes()))
            assert r.length == 2048 or n == 0
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_sequence) == -(-total // 2048)  # no fewer are possible


def test_ranks_give_the_ids_of_the_library():
    path = queries.public_tokenizers.path(queries.BYTE_VOCABULARY)
    library, rng = Tokenizer.from_file(path), random.Random(3)
    with open(path, encoding="utf-8") as file:
        ranks = byteranks.ByteRanks(file.read(), queries.public_tokenizers.PATTERN)
    letters_ = " \t\n\r\x0b\x1c\x85\xa0 　abzAZ019'.,!<|>éßſKⅧ²٣中😀‍́﻿\x00sdlmvtre"
    some = ["".join(rng.choices(letters_, k=rng.randint(0, 25))) for _ in range(3000)]
    for text in ["", "<|endoftext|>" * 3 + " <|endoftext|> q", "a" * 100_000, " " * 100_000, "é\n" * 50_000, *some]:
        assert ranks.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert ranks.encode(None).tolist() == []


def test_other_vocabularies_are_refused():
    with open(queries.public_tokenizers.path(queries.VOCABULARY), encoding="utf-8") as file:
        with pytest.raises((ValueError, KeyError, TypeError)):
            byteranks.ByteRanks(file.read(), queries.public_tokenizers.PATTERN)
