"""Connected components of an edge table within keys, as joins on a graph that shrinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespark.session import settle


def connected(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, node, component) of every node of ``edges`` (keys, a, b); a component is named by its smallest node.

    A round gives each node its smallest neighbour as label, follows labels one step further, and keeps only edges
    between different labels, as edges of labels. No group is gathered anywhere. An edge of a node to itself
    makes it a component.
    """
    k = list(keys)
    small, large = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    rest = settle(edges.select(*k, small, large).distinct())
    total = None
    while True:
        both = rest.union(rest.select(*k, F.col("b").alias("a"), F.col("a").alias("b")))
        label = settle(both.groupBy(*k, F.col("a").alias("node")).agg(F.min("b").alias("m")).select(*k, "node", F.least("node", "m").alias("label")))
        hop = label.select(*k, F.col("node").alias("label"), F.col("label").alias("next"))
        label = settle(label.join(hop, [*k, "label"]).select(*k, "node", F.col("next").alias("label")))
        if total is None:
            total = label
        else:
            hop = label.select(*k, F.col("node").alias("label"), F.col("label").alias("next"))
            total = settle(total.join(hop, [*k, "label"], "left").select(*k, "node", F.coalesce("next", "label").alias("label")))
        left = label.select(*k, F.col("node").alias("a"), F.col("label").alias("x"))
        right = label.select(*k, F.col("node").alias("b"), F.col("label").alias("y"))
        met = rest.join(left, [*k, "a"]).join(right, [*k, "b"]).where("x <> y")
        rest = settle(met.select(*k, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if rest.isEmpty():
            return total.select(*k, "node", F.col("label").alias("component"))
