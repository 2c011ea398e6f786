"""Connected components as DataFrame joins and aggregates.

Alternates the large-star and small-star steps: each rewires edges towards
the smallest neighbour until nothing changes, which takes a number of rounds
logarithmic in the longest path. There is no bound on rounds to fall short
of: the loop ends when the edges are stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import lineage


def components(edges: DataFrame, scratch: lineage.Scratch, by: list | None = None) -> DataFrame:
    """Components of edges (a, b), apart for each value of ``by``: rows (by,
    node, root) for every node that has an edge to another, root the smallest
    node of its component.

    A round is two grouped minima and two joins over the edge table. The
    minima are written first, so that the joins deal out plain rows and a node
    with very many edges can be split.
    """
    by = list(by or [])

    def cut_stars(df: DataFrame) -> DataFrame:
        return scratch.cut(df.where("a <> b").select(
            *by, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    edges, seen = cut_stars(edges), None
    while True:
        both = edges.unionByName(edges.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.cut(both.groupBy(*by, "a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = scratch.cut(both.join(low, [*by, "a"]).where("b > a and b <> m").select(
            *by, F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = scratch.cut(large.groupBy(*by, "a").agg(F.min("b").alias("m")))
        edges = cut_stars(
            large.join(low, [*by, "a"]).where("b <> m").select(*by, F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select(*by, "a", F.col("m").alias("b"))))
        now = tuple(edges.agg(F.count("*"), F.sum(F.hash(*by, "a", "b").cast("long")),
                              F.sum(F.xxhash64(*by, "a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    stars = edges.groupBy(*by, "a").agg(F.min("b").alias("b"))
    return scratch.cut(stars.select(*by, F.col("a").alias("node"), F.col("b").alias("root"))
                       .unionByName(stars.select(*by, F.col("b").alias("node"), F.col("b").alias("root"))).distinct())


def bipartite_components(edges: DataFrame, by: list, left: str, right: str,
                         scratch: lineage.Scratch) -> DataFrame:
    """Number of components ``comps`` of the (left key, right key) graph of
    each group, for the rank of a two-way effect design: rank([1, D_left,
    D_right]) = L + R - c."""
    e = edges.select(*by, F.concat(F.lit("L:"), F.col(left).cast("string")).alias("a"),
                     F.concat(F.lit("R:"), F.col(right).cast("string")).alias("b"))
    return scratch.cut(components(e, scratch, by).groupBy(*by).agg(F.countDistinct("root").alias("comps")))
