"""Connected components of an edge list, by alternating large and small stars.

Each round is a grouped minimum and a join, so a node with very many
neighbours is pre-aggregated and never gathered. The edges are cut off from
their lineage each round by ``checkpoint()`` in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a > b, both long)."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select("a", "b")
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    least = least.select("node", F.least("node", "m").alias("m"))
    out = both.join(least, both.a == least.node)
    if large:
        linked = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return linked.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node.

    Nodes without an edge are not listed. Null and self edges are ignored;
    no edges give no rows.
    """
    checkpoint_root(edges.sparkSession)
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(edges)
    while before[0]:
        edges = _star(_star(edges, large=True), large=False).checkpoint()
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
