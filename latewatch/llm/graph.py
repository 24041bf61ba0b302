"""Connected components by repeated minima, with every round stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from latewatch.session import durable


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for the ends of ``edges`` (a, b): label is the smallest node of the component.

    A round takes the smallest label among the neighbours, then the label of that label, so that long chains shorten by
    more than half; sums of a node with very many edges are made before they are shuffled.
    """
    both = durable(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        target = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        stepped = lower.join(target, "label").select("node", "old", F.col("further").alias("label"))
        changed = Observation()
        stepped = durable(stepped.observe(changed, F.count_if(F.col("old") != F.col("label")).alias("n")))
        labels = stepped.select("node", "label")
        if not changed.get["n"]:
            return labels
