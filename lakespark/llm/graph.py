"""Connected components of an edge table, as joins on a graph that shrinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespark.session import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); a component is named by its smallest node.

    Each round labels a node with its smallest neighbour, follows the labels to their end by doubling, and replaces
    nodes by labels. At most half of the nodes are left then, in whatever order a chain runs; the edges between
    them are all that the next round reads. The
    smallest node of a component keeps its name throughout. Tables are written between rounds. An empty edge
    table gives no rows; an edge of a node to itself makes it a component.
    """
    rest = settle(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    total = None
    while True:
        both = rest.union(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        label = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label"))
        label = settle(label)
        while True:
            hop = label.select(F.col("node").alias("before"), F.col("label").alias("next"))
            label = settle(label.select("node", F.col("label").alias("before")).join(hop, "before").select("node", F.col("next").alias("label"), "before"))
            if label.where("label <> before").isEmpty():
                break
        if total is None:
            total = label
        else:
            hop = label.select(F.col("node").alias("label"), F.col("label").alias("next"))
            total = settle(total.join(hop, "label", "left").select("node", F.coalesce("next", "label").alias("label")))
        left = label.select(F.col("node").alias("a"), F.col("label").alias("x"))
        right = label.select(F.col("node").alias("b"), F.col("label").alias("y"))
        joined = rest.join(left, "a").join(right, "b").where("x <> y")
        rest = settle(joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if rest.isEmpty():
            return total.select("node", F.col("label").alias("component"))
