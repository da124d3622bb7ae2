"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.session import drop_scratch, scratch, stored


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of an edge, component being the smallest node reachable.

    Each round every node takes the smallest label among its neighbours, then its label's own label, so that long
    chains shrink by doubling. Rounds end when no label changes; each is written to the shared folder, and the one
    before it deleted. Hubs are pre-aggregated and their joins can be split. Edges with a null end are ignored, loops make a component of their
    own, repeated edges don't matter, and an empty table gives no nodes.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    spark = edges.sparkSession
    links, at = scratch(spark), scratch(spark)
    both = stored(pairs.union(pairs.select("v", "u")).distinct(), links)
    labels = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("component")), at)
    while True:
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("component").alias("m"))
        step = labels.join(near, labels.node == near.u).select("node", F.col("component").alias("old"), F.least("component", "m").alias("l"))
        up = labels.select(F.col("node").alias("n2"), F.col("component").alias("l2"))
        then = scratch(spark)
        step = stored(step.join(up, F.col("l") == F.col("n2")).select("node", "old", F.least("l", "l2").alias("component")), then)
        changed = step.where("old <> component").limit(1).count()
        drop_scratch(spark, at)
        labels, at = step.drop("old"), then
        if not changed:
            drop_scratch(spark, links)
            return labels
