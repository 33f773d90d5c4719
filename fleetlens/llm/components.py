"""Connected components of a graph given as a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.tables import settle


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = settle(edges)
    total = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).head()
    return edges, (total["n"], total["h"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest one: those above the node, or those up to it."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = near.join(least, "a")
    if large:
        hung = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return hung.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) for each node of the links (a, b); a component is named by its smallest node.

    Every round at least halves the height of the trees, so rounds grow with the logarithm of the longest
    path.  With ``rounds`` it stops early: long components may then still be in parts, which are components of
    a part of the links.  Links of a node with itself, nulls and repeated links do not matter.
    """
    edges = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where(
        "a is not null and b is not null and a <> b")
    if rounds is not None:
        for _ in range(rounds):
            edges = settle(_star(_star(edges, large=True), large=False))
        # A node may still hang on several; its smallest one makes a part.
        named = edges.groupBy("a").agg(F.min("b").alias("b"))
        return named.select(F.col("a").alias("node"), F.col("b").alias("component"))
    edges, seen = _settled(edges.distinct())
    while seen[0]:
        edges, now = _settled(_star(_star(edges, large=True), large=False))
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
