"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for edges a, b; nodes without an edge are not listed.

    Each round every node takes the smallest label among its neighbours', then
    its label's label; rounds are written to the shared folder, and end when no
    label changes.  Rounds grow with the logarithm of a component's width.
    """
    edges = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a")).where("node <> other").distinct(), "edges")
    labels = stored(edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        step = step.join(jump, "label").select("node", "before", F.least("label", "jump").alias("label"))
        step = stored(step, "labels")
        if step.where("label <> before").isEmpty():
            return step.select("node", F.col("label").alias("component"))
        labels = step.select("node", "label")
