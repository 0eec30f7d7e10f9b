"""Classes of nodes that edges connect, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.store import discard, written


def components(edges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, node and label, the least node of its class, for every node of the edges (keys, a, b); classes lie inside equal keys.

    In each round a node takes the least label that it or a neighbour has, and the label of that label: the way to
    the least node is halved. A round's labels are written, so plans don't grow; the last one changes nothing.
    """
    ends = edges.select(*keys, "a", "b")
    both = written(ends.union(ends.select(*keys, "b", "a")).distinct(), "edges")
    label = written(both.groupBy(*keys, F.col("a").alias("node")).agg(F.min("b").alias("m")).select(*keys, "node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), [*keys, "b"]).groupBy(*keys, F.col("a").alias("node")).agg(F.min("label").alias("near"))
        least = label.join(near, [*keys, "node"]).select(*keys, "node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        # A label is a node of its class, so it has one too.
        up = label.select(*keys, F.col("node").alias("label"), F.col("label").alias("up"))
        new = written(least.join(up, [*keys, "label"]).select(*keys, "node", "was", F.least("label", "up").alias("label")), "labels")
        done = new.where("label <> was").limit(1).count() == 0
        discard(label)
        label = new.drop("was")
        if done:
            discard(both)
            return label
