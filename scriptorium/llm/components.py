"""Connected components of a table of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach from each node in them.

    Every round takes the smallest label among a node's neighbours, then the
    label of that label, so the rounds grow with the logarithm of a chain's
    length. Each round is written to the shared folder. Groups are reduced by
    partial aggregates; the joins have one row per node on one side, so
    that adaptive execution can split a hot node.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("m"))
        lower = labels.join(near, labels.node == near.a).select("node", "component", F.least("component", "m").alias("m"))
        lower = stored(lower)
        up = lower.select(F.col("node").alias("m"), F.col("m").alias("up"))
        jumped = stored(lower.join(up, "m").select("node", F.least("m", "up").alias("component"), (F.least("m", "up") < F.col("component")).alias("moved")))
        labels = jumped.select("node", "component")
        if jumped.where("moved").isEmpty():
            return labels
