import hashlib
import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ordinalis.llm import fingerprints as fp, queries


def plain_ends(data):
    """Boundaries by a byte-wise gear hash."""
    ends, start = [], 0
    while len(data) - start > fp.LEAST:
        end = None
        for i in range(start + fp.LEAST, min(len(data), start + fp.MOST) + 1):
            h = sum(int(fp._GEAR[b]) << d for d, b in enumerate(reversed(data[i - 32:i]))) & 0xFFFFFFFF
            if h >> (24 if i < start + fp.NORMAL else 26) == 0:
                end = i
                break
        end = end or min(len(data), start + fp.MOST)
        ends.append(end)
        start = end
    return ends + ([len(data)] if start < len(data) else [])


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=3000))
def test_boundaries_match_a_plain_loop(data):
    assert fp.chunk_ends(data) == plain_ends(data)


def test_an_insertion_keeps_most_chunks():
    text = "".join(random.Random(1).choices("abcdefgh é", k=20_000))
    a, b = fp.chunk_weights(text), fp.chunk_weights("inserted " + text[:9000] + "X" + text[9000:])
    assert fp.containment(a, b) > 0.9
    assert fp.containment(a, fp.chunk_weights("".join(random.Random(2).choices("ijkl", k=20_000)))) == 0


def expected(rows):
    """rows: (id, text) sorted by descending id, nulls last, smaller texts first."""
    out = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edit = text[:len(text) - half] + following[:half]
        own, its, nxt = map(fp.chunk_weights, (text, edit, following))
        out.append((key, len(text), edit, fp.written(own), fp.written(its), fp.containment(own, its), fp.containment(own, nxt)))
    return sorted(out, key=str)


def compare(spark, rows, partitions):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, fingerprint string, n_chars int").repartition(partitions)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    assert sorted(map(tuple, fp.edit_comparison(df).collect()), key=str) == expected(order)


def test_every_document_meets_the_next(spark):
    rng = random.Random(5)
    rows = [(i * 7 % 211, "".join(rng.choices("abc dé😀", k=rng.randint(0, 900)))) for i in range(200)]
    compare(spark, rows + [(-5, None), (500, ""), (501, "x" * 50_000), (None, "no id")], 4)


def test_few_rows_repeated_rows_and_ties(spark):
    compare(spark, [(1, "only")], 1)
    compare(spark, [(2, "b" * 90), (2, "a" * 90), (2, "a" * 90), (1, None), (3, "same"), (3, "same")], 3)
    compare(spark, [(None, "x"), (None, "y")], 2)
    assert fp.edit_comparison(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_columns_of_written_fingerprints(spark):
    df = spark.createDataFrame([("same text " * 30, "same text " * 30), ("a" * 100, None), ("", None)], "a string, b string")
    rows = df.select(fp.fingerprint("a").alias("x"), fp.fingerprint("b").alias("y")).select("x", "y", fp.likeness("x", "y").alias("l")).collect()
    assert [r.l for r in rows] == [1.0, 0.0, 1.0] and rows[0].x == rows[0].y and rows[2].x == rows[1].y == ""


def test_query_over_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy(F.desc("doc_id")).select("doc_id", "text").collect()
    found = sorted(map(tuple, queries.op10_chunk_fingerprints(spark, sf_dir).collect()), key=str)
    assert found == sorted([(k, n, hashlib.sha256(edit.encode()).hexdigest(), *rest) for k, n, edit, *rest in expected(list(map(tuple, docs)))], key=str)


def test_short_texts_are_seen_finely_enough():
    """Half of each text is kept; nearly all texts of some 400 bytes must still show it."""
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefghijklmnop ", k=rng.randint(350, 450))) for _ in range(300)]
    near = [fp.containment(fp.chunk_weights(a), fp.chunk_weights(fp.edited(a, b))) for a, b in zip(texts, texts[1:])]
    assert sum(n == 0 for n in near) < 0.05 * len(near)
