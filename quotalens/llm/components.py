"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two joins keyed by node with map-side minima; a hub with many neighbours is split
by the skew join, and no component is ever gathered in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotalens.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on distinct edges (a > b)."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        out = both.join(least, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, component): the least node reachable, for every node that has an edge.

    ``edges`` has long columns a and b; loops and repeated edges do no harm, null ends are
    dropped. Without edges the result is empty.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "edges")
    state = None
    for _ in range(limit):
        new = materialize(_star(_star(edges, True), False), "edges")
        # two numbers decide: a stable edge set is a set of stars around the least nodes
        now = new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = new
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state = now
    raise RuntimeError(f"components did not settle in {limit} rounds")
