"""Connected components by minimum labels with pointer jumping, over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for the nodes of undirected ``edges``; the label is the component's smallest node.

    Each round takes the least label around every node, then jumps along the labels, so that chains halve; rounds are
    staged in the shared folder, so lineage stays short. Labels only fall, which ends the loop.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    both = stage(e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        least = labels.join(around, "node").select("node", F.least("label", "near").alias("hop"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("hop"), F.col("label").alias("far"))
        new = stage(least.join(jump, "hop").select("node", F.least("hop", "far").alias("label"), "was"), "labels")
        moved = new.filter("label <> was").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels
