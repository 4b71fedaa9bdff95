import random
from collections import defaultdict
from math import sqrt

import pytest

from ordinalis.llm import queries, urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fitting = [(len(h + p), h + p, says) for says, h, p in queries.URL_RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fitting)[1:] if fitting else (None, None)


def form(path):
    import re

    out = []
    for s in path.split("/"):
        if s:
            s = re.sub(r"^[0-9]+(?=$|\.[A-Za-z0-9]{1,5}$)", "<n>", s)
            out.append(re.sub(r"^(?=[^.]*[0-9])[0-9A-Fa-f-]{8,}(?=$|\.)", "<h>", s))
    return tuple(out)


def tree(rows, max_children=32, max_depth=8, z=1.96, least_labels=5, prior=0.1, strength=5.0, unlabelled=0.1):
    """(host, form) -> (template, purity) by plain loops; rows: (host, form, bad)."""
    names = {(h, f): "" for h, f, _ in rows}
    for depth in range(max_depth):
        def child(f):
            if len(f) <= depth:
                return None
            return f[depth] if depth + 1 < max_depth or len(f) == depth + 1 else "**"
        nodes = defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for h, f, bad in rows:
            if child(f) is not None:
                cell = nodes[h, names[h, f]][child(f)]
                cell[0] += bad is not None
                cell[1] += bad or 0
        new = {}
        for (h, f), name in names.items():
            c = child(f)
            if c is None:
                new[h, f] = name
                continue
            kids = nodes[h, name]
            labelled, bad = (sum(k[i] for k in kids.values()) for i in (0, 1))
            n, b = kids[c]
            alike = least_labels <= n < labelled and abs(b / n - bad / labelled) <= z * sqrt(bad / labelled * (1 - bad / labelled) / n)
            new[h, f] = f"{name}/{'*' if len(kids) > max_children and n < least_labels else '+' if alike else c}"
        names = new
    total = defaultdict(lambda: [0, 0, 0])
    for h, f, bad in rows:
        cell = total[h, names[h, f]]
        cell[0] += bad is not None
        cell[1] += bad or 0
        cell[2] += unlabelled * (bad is None)
    return {k: (t, (total[k[0], t][1] + prior * (strength + total[k[0], t][2])) / (total[k[0], t][0] + strength + total[k[0], t][2]))
            for k, t in names.items()}


def expected(table, **options):
    rows = []
    for url in table:
        host, path = parts(url)
        name, says = rule_of(host, path)
        rows.append((host, path, name, says, form(path)))
    purity = tree([(h, f, None if s is None else int(s == "block")) for h, _, _, s, f in rows], **options)
    return [(h, p, name, purity[h, f][0], says or ("block" if purity[h, f][1] >= 0.5 else "allow")) for h, p, name, says, f in rows]


ODD = [None, "", "no scheme", "http://", "http://HOST.Com", "http://host.com?x=/a", "a://b://c/d", "http://x.net/es", "http://X.NET/es/1#f",
       "http://net/es/2", "https://www.example.com/en/1", "http://wwwexample.com/en/", "http://É.example.com/en/x y", "http://a.b/x\ny/2?z",
       "http://org/" + "/".join(f"s{i}" for i in range(20)), "http://org//double//slash/", "http://org/deadbeef01/12345678-12ab.html"]


@pytest.mark.parametrize("options", [{}, {"max_children": 3, "max_depth": 2, "least_labels": 2}])
def test_against_plain_loops(spark, options):
    rng = random.Random(2)
    table = ODD + ["http://{}.example.{}/{}/{}".format(rng.choice("abc"), rng.choice(["com", "net", "org"]), rng.choice(["en", "fr", "es", "x", "y"]),
                                                       rng.choice(["1", "22.html", "page", "about/us", "a/b/c"])) for _ in range(600)]
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(table)], "page_id long, url string, host string, template string").repartition(4)
    got = urls.judge(df, queries.URL_RULES, **options)
    assert got.columns.count("host") == got.columns.count("template") == 1
    found = {r.page_id: (r.host, r.path, r.rule, r.template, r.verdict) for r in got.collect()}
    assert found == dict(enumerate(expected(table, **options)))


def test_labels_reject_a_template_and_spare_its_neighbours(spark):
    rows = [(i, f"http://shop.org/{'bets' if i % 2 else 'news'}/{i}", i % 2 if i < 60 else None) for i in range(80)]
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    verdicts = {r.page_id: r.verdict for r in urls.judge(df, (), label=df["bad"]).collect()}
    assert verdicts == {i: "block" if i % 2 else "allow" for i in range(80)}


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), queries.URL_RULES).collect() == []


def test_query_over_all_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r.page_id: (r.host, r.path, r.rule, r.template, r.verdict) for r in queries.op5_url_templates(spark, sf_dir).collect()}
    assert found == dict(zip([r.page_id for r in pages], expected([r.url for r in pages])))


@pytest.mark.parametrize("segments", [32, 33, 200])
@pytest.mark.parametrize("blocked", [4, 40])
def test_verdicts_do_not_turn_with_the_number_of_branches(spark, segments, blocked):
    """Undecided pages of a host stay allowed, however many first segments it has beside the blocked one."""
    rows = [f"http://x.net/es/{i}" for i in range(blocked)] + [f"http://x.net/s{chr(97 + i % 26)}{chr(97 + i // 26)}/a" for i in range(segments - 1)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    found = [r.verdict for r in urls.judge(df, queries.URL_RULES).orderBy("page_id").collect()]
    assert found == ["block"] * blocked + ["allow"] * (segments - 1)


def test_columns_may_have_working_names(spark):
    df = spark.createDataFrame([(1, "http://x.net/es/1", "a", "b")], "page_id long, url string, _says string, _form string")
    assert urls.judge(df, queries.URL_RULES).select("page_id", "_says", "_form", "verdict").collect() == [(1, "a", "b", "block")]
