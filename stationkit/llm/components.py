"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.plans.stored import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node next to it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    tied = both.where("v > u").join(least, "u")
    return tied.select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Columns ``node, component`` for every node that has a link.

    ``links`` has two columns of node numbers, in any direction; loops, repeats
    and null ends are ignored. The component is the smallest node reachable.
    Each round is written to the shared folder, and the rounds end when the
    table no longer changes, so none is cut off. An empty table gives an empty
    one.
    """
    a, b = (F.col(f"`{c}`") for c in links.columns)
    edges = (
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(a.isNotNull() & b.isNotNull() & (a != b))
        .distinct()
    )
    measure = {"seal": F.bit_xor(F.xxhash64("a", "b"))}
    table, before = store(edges, "links", **measure), None
    while table.rows and (table.rows, table.seen["seal"]) != before:
        before = (table.rows, table.seen["seal"])
        table = store(_small_star(_large_star(table.df)), "stars", **measure)
    children = table.df.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = table.df.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return children.union(roots)
