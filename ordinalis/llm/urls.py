"""URL filters: rules for hosts and paths, and a tree of path templates per host.

Rules decide where one fits. The others are judged by their template: per host, the path's
segments form a tree. Segments that are numbers or long codes by their form, and those of a
node with too many different children, become wildcards; branches of a node whose labelled
shares of bad pages don't differ significantly are merged into one. A template is rejected
when its share of bad pages, smoothed towards ``prior``, reaches ``threshold``.

Only counts per (host, form of the path) are grown into trees; they are aggregated map-side,
so a host with most of the pages is as small as any other. Everything is built of DataFrame
operations; each level of the tree is written once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ordinalis.llm.common import spare_names
from ordinalis.storage import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a host."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(host + path, verdict) of the longest of ``rules`` (verdict, host, path) that fits; null if none.

    A rule fits its host and its subdomains if the path starts with its path. The list is a
    parameter of at most a few hundred entries, evaluated inside the projection.
    """
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name = verdict = F.lit(None).cast("string")
    for says, rule_host, rule_path in reversed(longest_first):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def path_form(path: Column) -> Column:
    """array of the path's segments, those that vary by their form replaced by wildcards:
    numbers (a file ending stays) and hexadecimal codes of eight digits or more."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(segments, lambda s: F.regexp_replace(
        F.regexp_replace(s, r"^[0-9]+(?=$|\.[A-Za-z0-9]{1,5}$)", "<n>"), r"^(?=[^.]*[0-9])[0-9A-Fa-f-]{8,}(?=$|\.)", "<h>"))


def path_templates(labelled: DataFrame, *, max_children: int = 32, max_depth: int = 8, z: float = 1.96,
                   least_labels: int = 5, prior: float = 0.1, strength: float = 5.0,
                   unlabelled: float = 0.1) -> DataFrame:
    """(host, form, template, pages, labelled, bad, purity) from (host, form, bad).

    ``bad`` is 1, 0 or null (no label). Segments beyond ``max_depth`` are one wildcard. Each child
    of a node with ``least_labels`` labels that a two-share test (``z``) can't tell from the node's
    labelled pages as a whole joins the node's merged branch; one that it can stays apart, however many
    children there are. Of a node with more than ``max_children`` children those with fewer labels
    become one wildcard; of others they stay apart. A template's purity is drawn to ``prior`` by
    ``strength`` pages and by each page without a label, which weighs ``unlabelled``: a few
    labels decide little about many pages that have none.
    """
    rows = labelled.groupBy("host", "form").agg(
        F.count(F.lit(1)).alias("pages"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    rows = cut(rows.withColumn("template", F.lit("")), "url-forms")
    deepest = rows.agg(F.max(F.size("form"))).first()[0] or 0
    for depth in range(min(deepest, max_depth)):
        child = F.when(F.size("form") > depth, F.element_at("form", depth + 1) if depth + 1 < max_depth
                       else F.when(F.size("form") > depth + 1, "**").otherwise(F.element_at("form", depth + 1)))
        rows = rows.withColumn("_child", child)
        children = (rows.where(F.col("_child").isNotNull()).groupBy("host", "template", "_child")
                    .agg(F.sum("labelled").alias("_l"), F.sum("bad").alias("_b")))
        nodes = children.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("_k"), F.sum("_l").alias("_all"), F.sum("_b").alias("_bad"))
        share, whole = F.col("_b") / F.col("_l"), F.col("_bad") / F.col("_all")
        spread = F.sqrt(whole * (1 - whole) / F.col("_l"))
        alike = (F.col("_l") >= least_labels) & (F.col("_l") < F.col("_all")) & (F.abs(share - whole) <= z * spread)
        named = (children.join(nodes, ["host", "template"])
                 .withColumn("_as", F.when((F.col("_k") > max_children) & (F.col("_l") < least_labels), "*").when(alike, "+").otherwise(F.col("_child")))
                 .select("host", "template", "_child", "_as"))
        # a path that has ended keeps its template: its _child is null and finds no partner
        rows = cut(rows.join(named, ["host", "template", "_child"], "left")
                   .withColumn("template", F.when(F.col("_as").isNull(), F.col("template"))
                               .otherwise(F.concat("template", F.lit("/"), "_as"))).drop("_child", "_as"), "url-tree")
    of_template = rows.groupBy("host", "template").agg(
        F.sum("labelled").alias("_l"), F.sum("bad").alias("_b"), F.sum("pages").alias("_p"))
    smooth = strength + unlabelled * (F.col("_p") - F.col("_l"))
    purity = (F.col("_b") + prior * smooth) / (F.col("_l") + smooth)
    of_template = cut(of_template.select("host", "template", purity.alias("purity")), "url-purity")
    return (rows.join(of_template, ["host", "template"])
            .select("host", "form", "template", "pages", "labelled", "bad", "purity"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], *, url_col: str = "url", label: Column | None = None,
          threshold: float = 0.5, **tree) -> DataFrame:
    """``pages`` with host, path, rule, template, purity and verdict (allow or block).

    ``label`` (1 bad, 0 good, null) teaches the tree; without it the pages that a rule
    decides are the labelled ones. A null url, or one without ``://``, has an empty host and
    path. Columns of these names are replaced; repeated rows are judged alike and count each.
    An empty table stays empty.
    """
    url = F.col(url_col)
    said, shape = spare_names(pages, "_says", "_form")
    rows = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    name, says = best_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, said: says, shape: path_form(F.col("path"))})
    bad = label if label is not None else F.when(F.col(said) == "block", 1).when(F.col(said) == "allow", 0)
    templates = cut(path_templates(rows.select("host", F.col(shape).alias("form"), bad.cast("int").alias("bad")), **tree)
                    .select("host", F.col("form").alias(shape), "template", "purity"), "url-templates")
    by_template = F.when(F.col("purity") >= threshold, "block").otherwise("allow")
    return (rows.drop("template", "purity").join(templates, ["host", shape], "left")
            .withColumn("verdict", F.coalesce(said, by_template)).drop(said, shape))
