import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordinalis.llm import packing, queries


def letters(text):
    return np.array([ord(c) for c in text or ""], "<u4")


def checked(rows, docs, length):
    """docs: id -> list of id lists. Every id lies in one piece, sequences are gapless."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for key, wanted in docs.items():
        pieces = sorted((r.start, r.length, bytes(r.ids), r.doc_tokens) for r in by_doc[key])
        assert sum(p[1] for p in pieces) == sum(map(len, wanted))
        if len(wanted) == 1:
            ids = np.array(wanted[0], "<u4")
            at = 0
            for start, n, data, total in pieces:
                assert (start, data, total) == (at, ids[at:at + n].tobytes(), len(ids))
                at += n
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length == len(r.ids) // 4 > 0
            at += r.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


@pytest.mark.parametrize("open_windows", [1, 3])
@pytest.mark.parametrize("partitions", [1, 20])
def test_every_id_lies_in_one_piece(spark, open_windows, partitions):
    rng = random.Random(4)
    texts = [None, "", "", "x" * 1000, *("".join(rng.choices("abcd", k=rng.randint(0, 90))) for _ in range(300))]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, length int").repartition(partitions)
    pieces = packing.pack(docs, letters, 2, length=32, open_windows=open_windows)
    assert pieces.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    wanted = {i: [[*letters(t).tolist(), 2]] for i, t in enumerate(texts)}
    assert checked(pieces.collect(), wanted, 32) == 0


def test_repeated_rows_null_ids_and_the_empty_table(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (None, "x"), (None, None)], "doc_id long, text string")
    rows = packing.pack(docs, letters, 2, length=8).collect()
    checked(rows, {1: [[*b"same", 2]] * 2, None: [[ord("x"), 2], [2]]}, 8)
    assert packing.pack(docs.limit(0), letters, 2).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, letters, 2, length=100)


def test_query_over_all_documents(spark, sf_dir):
    library = Tokenizer.from_file(queries.public_tokenizers.path(queries.VOCABULARY))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    pieces = queries.op8_window_packing(spark, sf_dir)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    total = pieces.agg(F.sum("length")).first()[0]
    by_doc = defaultdict(list)
    for r in pieces.collect():
        by_doc[r.doc_id].append(r)
    assert total == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in texts.values())
    import zlib

    for key, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(ids[at:at + r.length].tobytes()), len(ids))
            at += r.length
        assert at == len(ids)


def test_the_query_encodes_with_ranked_merges(spark, sf_dir, monkeypatch):
    kinds, pack = [], packing.pack

    def loaded(vocabulary, cached_cuts, kind=queries.bpe.WordEndBpe):
        kinds.append(kind)
        return kind(vocabulary.value, cached_cuts)

    def pack_letters(docs, encode, end_id):
        encode("word")  # here, not in a worker
        return pack(docs.limit(5), letters, end_id)

    monkeypatch.setattr(queries.bpe, "loaded", loaded)
    monkeypatch.setattr(packing, "pack", pack_letters)
    queries.op8_window_packing(spark, sf_dir)
    assert kinds == [queries.bpe.RankedBpe]
