"""Connected components of an edge list, by least labels and short cuts.

Each round gives every node the least label among its own and its
neighbours', then replaces it by that label's own label, so chains shrink by
half. A round is a grouped minimum and two joins; lineage is cut by
``checkpoint()`` in the shared folder after each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for each node of the edges (a, b: long): the least node it is linked to.

    Null ends and loops are ignored; nodes without an edge are not listed.
    """
    checkpoint_root(edges.sparkSession)
    links = edges.where("a <> b").select("a", "b")
    links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")).checkpoint()
    while True:
        near = links.join(labels, links.b == labels.node).groupBy("a").agg(F.min("label").alias("m"))
        now = labels.join(near, labels.node == near.a).select("node", F.least("label", "m").alias("label"))
        of = now.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        now = now.join(of, now.label == of.n2).select("node", F.col("l2").alias("label")).checkpoint()
        old = labels.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        if now.join(old, now.node == old.n2).where("label <> l2").isEmpty():
            return now
        labels = now
