"""Connected components of links by alternating stars; every round is a written table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links(a, b): root is the smallest node it is connected with.

    Large stars hang a node's larger neighbours on its smallest one, small stars the smaller ones; the rounds
    grow with the logarithm of the nodes. A star's centre is one row, so a node of many links is a
    skewed join key, which adaptive execution splits, and never a group held together.
    """
    edges = materialise(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"),
    ).distinct())
    last = None
    while True:
        edges = materialise(small_star(large_star(edges)))
        state = tuple(edges.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))),
        ).first())
        if state == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        last = state


def large_star(edges: DataFrame) -> DataFrame:
    """(a, b) with a > b: for every node, its larger neighbours with the smallest of itself and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b").distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """The same for smaller neighbours: each, and the node itself, with the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return (
        edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", "least"))
        .where("a <> b").distinct()
    )
