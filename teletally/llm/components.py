"""Connected components of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teletally.storage import store


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for all nodes of links ``a``, ``b``.

    Every node takes the smallest label among its neighbours, then the label of that label, which
    halves the remaining distances; each round is written to the shared folder, so lineage stays
    short and a lost executor costs a re-read. Neighbours of a node are only ever reduced to their
    minimum, partially before each shuffle, so a node with very many links is no bottleneck.
    Repeated links, loops and either direction are fine; links with a null end are left out.
    """
    whole = links.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b")
    both = store(whole.union(whole.select("b", "a")).distinct(), "links")
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    labels = store(lowest.select(F.col("a").alias("node"), F.least("a", "low").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b")
        near = near.groupBy("a").agg(F.min("component").alias("low"))
        better = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select(
            "node", F.col("component").alias("before"), F.least("component", "low").alias("label")
        )
        target = labels.select(F.col("node").alias("label"), F.col("component").alias("onward"))
        jumped = better.join(target, "label", "left").select(
            "node", F.coalesce(F.least("label", "onward"), "label").alias("component"), "before"
        )
        found = store(jumped, "labels")
        labels = found.select("node", "component")
        if found.where(F.col("component") != F.col("before")).isEmpty():
            return labels
