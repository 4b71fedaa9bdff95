import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st

import numpy as np
from ordinalis.llm import graph, jaccard, queries


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def similar(a, b):
    common = len(a & b)
    return 100 * common >= 75 * (len(a) + len(b) - common)


def brute(texts):
    """(id, text) rows -> list of (id, n, smallest reachable id)."""
    sets = [shingles(t) for _, t in texts]
    above = list(range(len(sets)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for j, common in Counter(j for s in own for j in holders[s]).items():
            if 100 * common >= 75 * (len(own) + len(sets[j]) - common):
                above[root(i)] = root(j)
        for s in own:
            holders[s].append(i)
    lowest = {}
    for i, (key, _) in enumerate(texts):
        if key is not None:
            lowest[root(i)] = min(key, lowest.get(root(i), key))
    return [(key, len(sets[i]), lowest.get(root(i)) if sets[i] else key) for i, (key, _) in enumerate(texts)]


def compare(spark, texts):
    df = spark.createDataFrame([(k, t, 7, "clash") for k, t in texts], "doc_id long, text string, n_shingles int, token string").repartition(4)
    order = lambda row: tuple((x is None, x or 0) for x in row)
    got = jaccard.similar_components(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=order) == sorted(brute(texts), key=order)


def mixture(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]

    def some(least, most):
        return " ".join(rng.choices(vocabulary, k=rng.randint(least, most)))

    def edited(text, share):
        return " ".join(rng.choice(vocabulary) if rng.random() < share else w for w in text.split(" "))

    base, line = some(120, 120), some(25, 25)
    texts = [edited(base, rng.choice([0.005, 0.01, 0.02, 0.04])) for _ in range(100)]  # one large group of near copies
    texts += [f"{some(0, 90)} {line} {some(0, 90)}" for _ in range(200)]  # one line that many texts share
    for _ in range(80):
        short = some(1, 12)
        texts += [edited(short, 0.05) for _ in range(rng.randint(1, 4))]
    texts += [None, "", " \t\r\n", base.upper(), base, base, some(20_000, 20_000)]
    return [(i * 3 % len(texts) if len(texts) % 3 else i, t) for i, t in enumerate(texts)]


def test_mixture_with_usual_limits(spark):
    compare(spark, mixture(1))


def test_mixture_with_small_limits(spark, monkeypatch):
    """Long lists and tiles come into play."""
    for name, value in (("SHORT_LIST", 4), ("TILE_SETS", 16), ("_BROADCAST_ROWS", 0)):
        monkeypatch.setattr(jaccard, name, value)
    compare(spark, mixture(2))


def test_repeated_rows_null_ids_and_one_id_for_two_texts(spark):
    a, b = "one two three four five six seven", "other words that stand for another text"
    compare(spark, [(1, a), (1, a), (1, b), (2, b), (None, a), (None, "alone with this text here now"), (None, None), (4, ""), (4, "")])


def test_border_of_the_similarity(spark):
    """Sets of 7 with 6 in common: 6/8 is exactly 0.75 and links; 5 of 7 doesn't."""
    words = [f"v{i}" for i in range(11)]
    compare(spark, [(0, " ".join(words)), (1, " ".join([*words[:-1], "x"])), (2, " ".join([*words[:-2], "y", "z"]))])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar_components(empty).collect() == [] and jaccard.keep_one(empty).collect() == []


def test_one_text_of_each_group_stays(spark):
    texts = mixture(3)
    rows = [(k, t, i) for i, (k, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, other int").repartition(3)
    kept = sorted(r.doc_id for r in jaccard.keep_one(df).collect())
    assert kept == sorted(k for k, n, lowest in brute(texts) if not n or k == lowest)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 12), min_size=1, max_size=10), min_size=1, max_size=25))
def test_divide_skip_connects_what_is_similar(found):
    sets = [np.array(sorted(s), np.uint64) for s in found]
    for same in (True, False):
        links = jaccard.divide_skip(sets, sets, same)
        assert all(similar(found[q], found[o]) for q, o in links)
        above = list(range(len(sets)))

        def root(i):
            while above[i] != i:
                i = above[i]
            return i

        for q, o in links:
            above[root(q)] = root(o)
        if same:
            assert all(root(i) == root(j) for i in range(len(sets)) for j in range(i) if similar(found[i], found[j]))


@settings(max_examples=200, deadline=None)
@given(st.frozensets(st.integers(0, 60), min_size=1), st.frozensets(st.integers(0, 60), min_size=1))
def test_similar_sets_share_a_prefix(a, b):
    if similar(a, b):
        first = [set(sorted(s)[:jaccard.prefix_length(len(s))]) for s in (a, b)]
        assert first[0] & first[1]


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}


def test_what_similar_sets_share_is_never_overstated(spark):
    """Random similar sets share at least what the filters ask for, whichever prefix ends first."""
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(3000):
        n = int(rng.integers(1, 700))
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        lost, more = int(rng.integers(0, n // 4 + 1)), int(rng.integers(0, n // 3 + 1))
        b = np.concatenate([a[lost:], rng.integers(0, 1 << 62, more).astype(np.uint64)])
        if similar(set(a.tolist()), set(b.tolist())):
            first = [np.sort(x)[:jaccard.prefix_length(len(x))] for x in (a, b)]
            ends_first = int(first[1][-1] < first[0][-1])
            rows.append((n, len(b), (n, len(b))[ends_first], len(np.intersect1d(*first))))
    df = spark.createDataFrame(rows, "na long, nb long, own long, common long")
    asked = df.select("common", jaccard.shared_at_least(df["own"]).alias("own"), jaccard.least_shared(df["na"]).alias("a"), jaccard.least_shared(df["nb"]).alias("b"))
    assert len(rows) > 300 and asked.where("own > common or a > own or b > own").count() == 0


def test_query_over_all_documents(spark, sf_dir):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op4_ngram_jaccard(spark, sf_dir).collect())) == sorted(brute(texts))


def test_columns_may_have_working_names(spark):
    text, names = " ".join(f"w{i}" for i in range(9)), ["_id", "_key", "_of", "_its"]
    rows = [(1, text, *names), (2, text, *names), (3, None, *names), (4, "", *names)]
    got = jaccard.keep_one(spark.createDataFrame(rows, ["doc_id", "text", *names])).collect()
    assert sorted(r.doc_id for r in got) == [1, 3, 4] and all([r[n] for n in names] == names for r in got)


def test_joins_by_hot_keys_have_written_sides(spark):
    """One shingle in all sets, one giant component, one hub: no aggregate stands under a join without an exchange."""
    edges = graph.components(spark.range(1, 2000).selectExpr("0L as a", "id as b"))
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and edges.where("component != 0").count() == 0
