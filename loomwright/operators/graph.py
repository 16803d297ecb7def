"""Connected components for leakage groups."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ready_to_checkpoint(spark: SparkSession) -> None:
    """See that checkpoints go to the folder in spark.checkpoint.dir; a temporary one where that is unset."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = context.getConf().get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="loomwright-"))


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, component) from edges (a, b): the smallest node that can be reached.

    Each round every node takes its least neighbour below it as its parent, nodes
    are led to the tops of these trees, and edges go on between different tops
    alone, once each.  A top that isn't the least neighbour of the nodes above it
    gets an edge to one below, so two rounds leave at most half of the nodes.
    ``edges`` are read several times in the first round; what is left of them is
    checkpointed, so that plans stay short and executors may be lost.  More rounds
    than any graph needs raise an error and leave nothing out.
    """
    ready_to_checkpoint(edges.sparkSession)
    least, most = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
    left = edges.filter("a is not null and b is not null").select(least, most)
    levels: list[DataFrame] = []
    while not left.filter("low < high").isEmpty():
        if len(levels) >= rounds:
            raise RuntimeError("the components need more rounds")
        up = _tops(left, rounds)
        levels.append(up)
        half = left.filter("low < high").join(up.select(F.col("node").alias("high"), F.col("top").alias("b")), "high")
        half = half.select("low", "b").filter("low <> b").distinct()
        tops = half.join(up.select(F.col("node").alias("low"), F.col("top").alias("a")), "low").filter("a <> b")
        left = tops.select(least, most).distinct().checkpoint()
    if not levels:
        return left.distinct().select(F.col("low").alias("node"), F.col("high").alias("component"))
    found = levels.pop()
    while levels:
        below, above = levels.pop(), found.select(F.col("node").alias("top"), F.col("top").alias("further"))
        found = below.join(above, "top", "left").select("node", F.coalesce("further", "top").alias("top"))
    return found.select("node", F.col("top").alias("component"))


def _tops(edges: DataFrame, rounds: int) -> DataFrame:
    """(node, top): where each node of the edges (low, high) gets by going to the least neighbour, from node to node."""
    parents = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("top"))
    # A node that is never the higher end is a top.
    lows = edges.select(F.col("low").alias("node")).distinct().withColumn("top", F.col("node"))
    up = parents.union(lows).groupBy("node").agg(F.min("top").alias("top")).checkpoint()
    for _ in range(rounds):
        further = up.select(F.col("node").alias("top"), F.col("top").alias("further"))
        after = up.join(further, "top").select("node", F.col("further").alias("top"), (F.col("further") != F.col("top")).alias("moved")).checkpoint()
        if after.filter("moved").isEmpty():
            return after.drop("moved")
        up = after.drop("moved")
    raise RuntimeError("the components need more rounds")
