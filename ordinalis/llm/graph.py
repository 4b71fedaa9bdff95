"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ordinalis.llm.common import cut_small
from ordinalis.storage import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "smallest")
    return (both.where("b > a").join(smallest, "a").select(F.col("m").alias("a"), "b").where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    smallest = cut(edges.groupBy("b").agg(F.min("a").alias("m")), "smallest")
    near = edges.join(smallest, "b")
    return (near.select(F.col("m").alias("a"), F.col("a").alias("b"))
            .unionByName(near.select(F.col("m").alias("a"), "b")).where("a != b").distinct())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node with an edge, and the smallest node of its component.

    Each round writes its edges; the number of rounds grows with the logarithm of the nodes.
    Aggregates are combined map-side and written before they are joined, so that both sides of a
    join have an exchange and may be split: a node of any degree is fine.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    now = edges.select(low.alias("a"), high.alias("b")).where("a != b").distinct()
    now = cut_small(now, "edges", edges.count())

    def mark(table: DataFrame):
        return table.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()

    before = mark(now)
    while before[0]:
        now = cut_small(_small_star(_large_star(now)), "edges", before[0])
        after = mark(now)
        if tuple(after) == tuple(before):
            break
        before = after
    roots = now.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
