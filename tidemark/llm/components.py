"""Connected components of a graph given as an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` for every node that an edge touches; the root is the smallest node of the component.

    Each round points every node at its smallest neighbour, follows the pointers twice, and contracts the
    edges to what is left between different targets. Node values must be in no special order along paths
    (hashes are), so a round removes a fixed share of the nodes on average. All state is tables: nothing is collected.
    """
    pair = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()
    edge = materialize(pair, "edges")
    label = None
    while not edge.isEmpty():
        both = edge.union(edge.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("p")), "parents")
        for _ in range(2):
            up = parent.select(F.col("n").alias("p"), F.col("p").alias("pp"))
            higher = materialize(parent.join(up, "p", "left").select("n", F.coalesce("pp", "p").alias("p")), "parents")
            discard(parent)
            parent = higher
        if label is None:
            new = parent.select(F.col("n").alias("node"), F.col("p").alias("root"))
        else:
            new = label.join(parent.withColumnRenamed("n", "root"), "root", "left").select("node", F.coalesce("p", "root").alias("root"))
        new = materialize(new, "labels")
        left = parent.select(F.col("n").alias("a"), F.col("p").alias("pa"))
        right = parent.select(F.col("n").alias("b"), F.col("p").alias("pb"))
        joined = edge.join(left, "a").join(right, "b").where("pa <> pb")
        smaller = materialize(joined.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        for old in (edge, parent, label):
            if old is not None:
                discard(old)
        edge, label = smaller, new
    if label is None:
        return edge.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # A root may have become a child in a later round; labels follow by the join above, so they are final here.
    return label
