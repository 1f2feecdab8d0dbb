"""Connected components of an edge table by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); the component
    is its smallest node. Labels stay on the cluster; the driver reads one count
    a round."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("component", "label"), F.col("b") == F.col("node"))
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        own = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        own = stored(own, "labels")
        jump = own.select(F.col("node").alias("component"), F.col("component").alias("jumped"))
        new = stored(own.join(jump, "component").select("node", F.col("jumped").alias("component"), "old"), "labels")
        changed = new.where("component != old").limit(1).count()
        discard(own)
        discard(labels)
        labels = new.select("node", "component")
        labels._stored_at = new._stored_at
        if not changed:
            discard(both)
            return labels
