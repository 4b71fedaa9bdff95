import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ordinalis.llm import importance, queries
from tests.oracle import connect, differences

TEXTS = [None, "", " .,- ", "one", "One two THREE", "İstanbul ÀB'c d-e_f\x00g 12 éé", "a a a a", "word " * 30, "x" * 500,
         "the cat sat on the mat and then the dog came " * 4]


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def runs(text, least_n, most_n):
    words = words_of(text)
    return [" ".join(words[i:i + n]) for n in range(least_n, most_n + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, percent, least_n=1, most_n=1, buckets=10_000, seed=2024, least_words=20):
    """docs: (id, text). id, n_words, n_features, weight, score, rank by plain loops."""
    bucket = lambda run: zlib.crc32(run.encode()) % buckets
    found = [Counter(map(bucket, runs(text, least_n, most_n))) for _, text in docs]
    corpus, wanted = sum(found, Counter()), sum((Counter(map(bucket, runs(t, least_n, most_n))) for t in target), Counter())
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets)))) for b in corpus}
    rows = []
    for (key, text), counts in zip(docs, found):
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * n for b, n in counts.items())
        rows.append([key, len(words_of(text)), sum(counts.values()), weight,
                     weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    eligible = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = [tuple(r) for r in eligible[:len(eligible) * percent // 100]]
    result = [(*r, n + 1) for n, r in enumerate(drawn)]
    left = Counter(map(tuple, rows)) - Counter(drawn)
    return Counter(result) + Counter({(*r, None): n for r, n in left.items()})


def made(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect())


def table(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, buckets string, _place int")


@pytest.mark.parametrize("least_n,most_n", [(1, 1), (1, 3), (2, 2)])
def test_equals_plain_loops(spark, least_n, most_n):
    docs = [*enumerate(TEXTS * 5), (None, TEXTS[-1]), (None, None), (3, "one"), (3, "one")]
    target = ["the cat and the dog", None, "word"]
    wanted = plain(docs, target, 50, least_n, most_n, buckets=97, least_words=3)
    targets = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(table(spark, docs).repartition(5), targets, 50, least_n=least_n, most_n=most_n, buckets=97, least_words=3)
    assert made(got) == wanted


def test_spans_are_those_of_the_words():
    for text in TEXTS:
        collapsed = importance.collapsed((text or "").encode())
        for n in (1, 2, 4):
            spans = [m[0].decode() for m in importance.run_pattern(n).finditer(collapsed, overlapped=True)]
            assert spans == runs(text, n, n)


def test_draw_is_whole_over_many_ranges_and_equal_scores(spark, monkeypatch):
    monkeypatch.setattr(importance, "ROWS_PER_RANGE", 50)
    rows = [(i, 20 + i % 2, 5, 7, 1 if i % 3 else i) for i in range(1000)] + [(5, 20, 5, 7, 1)] * 300 + [(2000, 3, 5, 7, 10**9)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    for percent in (0, 1, 37, 100):
        got = importance.draw(scored, percent).collect()
        eligible = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0]))
        n = len(eligible) * percent // 100
        ranked = sorted((r.rank, r.score, r.doc_id) for r in got if r.rank)
        assert ranked == [(i + 1, r[4], r[0]) for i, r in enumerate(eligible[:n])] and len(got) == len(rows)


def test_too_high_an_estimate_is_mended(spark, monkeypatch):
    monkeypatch.setattr(importance.F, "percentile_approx", lambda *a: F.max("score"))
    rows = [(i, 20, 1, 1, i) for i in range(50)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = {r.doc_id: r.rank for r in importance.draw(scored, 50).collect()}
    assert got == {i: 50 - i if i >= 25 else None for i in range(50)}


def test_empty_tables(spark):
    docs, none = table(spark, [(i, "word " * 25) for i in range(10)]), table(spark, [])
    assert importance.resample(none, docs, 10).collect() == []
    assert made(importance.resample(docs, none, 10)) == plain([(i, "word " * 25) for i in range(10)], [], 10)
    with pytest.raises(ValueError):
        importance.features(docs, least_n=2, most_n=1)


def test_prefers_what_looks_like_the_target(spark):
    docs = [(i, ("cat dog bird " if i % 10 == 0 else "tax law rent ") * 20) for i in range(500)]
    target = spark.createDataFrame([("dog bird cat",)] * 20, "text string")
    drawn = importance.resample(table(spark, docs), target, 10).where("rank is not null").collect()
    assert len(drawn) == 50 and all(r.doc_id % 10 == 0 for r in drawn)


def test_query_matches_sql(spark, sf_dir):
    name = "op12_importance_resampling"
    assert differences(queries.LLM_QUERIES[name](spark, sf_dir), queries_sql()[name], connect(sf_dir)) == []


def queries_sql():
    from ordinalis.llm.oracles import LLM_ORACLES
    return LLM_ORACLES
