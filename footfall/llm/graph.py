"""Connected components of links between nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import cut


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, comp`` of all nodes in ``links``: the smallest node that each one reaches.

    Every round a node takes the smallest label among its own and its neighbours', then
    the label of that label, so that long chains shorten fast. A round is written to the
    shared folder; the driver sees the number of changes only.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = cut(both.union(both.select("y", "x")).distinct(), "links")
    labels = both.groupBy("x").agg(F.least("x", F.min("y")).alias("comp")).withColumnRenamed("x", "node")
    labels = cut(_jump(labels, labels), "labels")
    while True:
        near = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("comp").alias("near"))
        step = labels.join(near, labels["node"] == near["x"], "left")
        step = step.select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("was"))
        step = cut(_jump(step, labels), "labels")
        if step.filter("comp < was").isEmpty():
            return labels
        labels = step.drop("was")


def _jump(step: DataFrame, labels: DataFrame) -> DataFrame:
    """Each label replaced by the label of the node it names, where that is smaller."""
    up = labels.select(F.col("node").alias("up"), F.col("comp").alias("up_comp"))
    found = step.join(up, F.col("comp") == F.col("up"), "left")
    rest = [c for c in step.columns if c not in ("node", "comp")]
    return found.select("node", F.least("comp", "up_comp").alias("comp"), *rest)
