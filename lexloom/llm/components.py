"""Connected components of an edge table, by least labels with pointer jumping; every step is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) for all nodes of ``edges`` (a, b); the label is the least node reachable."""
    both = store(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("l")).select("node", F.least("node", "l").alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("l"))
        step = labels.join(near, labels["node"] == near["a"], "left").select("node", F.least("label", F.coalesce("l", "label")).alias("label"), F.col("label").alias("was"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        new = store(step.join(up, "label", "left").select("node", F.least("label", F.coalesce("top", "label")).alias("label"), "was"), "labels")
        if new.where("label <> was").limit(1).count() == 0:
            return new.select("node", "label")
        labels = new.select("node", "label")
    raise RuntimeError("components did not settle")
