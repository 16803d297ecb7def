"""Connected components by smallest labels, with joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """(node, component) for every node of ``links`` (a, b); component: smallest node.

    Each round gives a node the smallest label among its neighbours' and its own,
    then the label of that label, so chains shorten by powers.  Both sides of
    each join are read from written tables: a node with very many links is then
    split by adaptive execution.  Returns the written table and its path.
    """
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter("a <> b")
    edges, edges_at = materialize(both, "edges", short=True)
    first = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    labels, labels_at = materialize(first.select("node", F.least("node", "m").alias("component")), "labels", short=True)
    # Labels only fall, so they stand still when their sum does.
    total = lambda x: x.agg(F.sum(F.col("component").cast("decimal(38,0)")).alias("s")).first()["s"]
    before = total(labels)
    while True:
        seen = edges.join(labels, edges["b"] == labels["node"]).select(F.col("a").alias("node"), "component")
        least = seen.union(labels).groupBy("node").agg(F.min("component").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        jumped = least.join(jump, "component", "left").select(
            "node", F.least("component", F.coalesce("further", "component")).alias("component")
        )
        after, after_at = materialize(jumped, "labels", short=True)
        discard(spark, labels_at)
        labels, labels_at, now = after, after_at, total(after)
        if now == before:
            discard(spark, edges_at)
            return labels, labels_at
        before = now
