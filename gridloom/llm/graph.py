"""Connected components of edges that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, comp) of every node of `edges` (a, b): comp is the smallest node it reaches.

    Labels sink along edges and along labels of labels until none changes, so long
    chains take logarithmically many rounds. Each round is a written table; joins on
    hot nodes are plain sort-merge joins, which Spark splits.
    """
    both = scratch.write(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b"), f"{name}-both")
    labels = scratch.write(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("comp")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        sunk = scratch.write(labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low")), f"{name}-sunk")
        jump = sunk.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        moved = scratch.write(sunk.join(jump, "low").select("node", F.col("lower").alias("comp"), (F.col("lower") != F.col("comp")).alias("moved")), f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        labels = moved.select("node", "comp")
        if moved.where("moved").isEmpty():
            scratch.drop(f"{name}-both", f"{name}-sunk")
            return labels
