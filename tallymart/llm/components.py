"""Connected components over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.tables import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (a, b), for nodes that have an edge.

    Every round each node takes the least label among itself, its neighbours and its own
    label's label, so stars close in one round and chains in a logarithmic number.  Labels
    are a written table each round: a hub's edges and labels meet in a join of two scans,
    which AQE splits.
    """
    both = scratch.put(f"{name}-edges", edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = scratch.put(f"{name}-0", both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label"), F.lit(True).alias("moved")))
    step = 0
    while not labels.filter("moved").isEmpty():
        heard = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("jumped"))
        found = labels.select("node", "label").join(heard, "node").join(jump, "label")
        new = F.least("label", "heard", "jumped")
        after = scratch.put(f"{name}-{step + 1}", found.select("node", new.alias("label"), (new < F.col("label")).alias("moved")))
        scratch.drop(f"{name}-{step}")
        labels, step = after, step + 1
    scratch.drop(f"{name}-edges")
    return labels.select("node", "label")
