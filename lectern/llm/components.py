"""Connected components by label propagation with pointer jumping; all state is distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans.durable import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: a, b of any one ordered type. Returns v, label: each vertex with the least vertex of its component.

    Loops and repeated edges do no harm; rows with nulls are ignored; no edges give no rows. Joined
    tables are checkpointed, so that a vertex with very many edges is split by adaptive execution.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = checkpointed(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("label")))
    while True:
        heard = both.join(labels.withColumnRenamed("v", "a"), "a").groupBy(F.col("b").alias("v")).agg(F.min("label").alias("heard"))
        new = checkpointed(labels.join(heard, "v").select("v", F.col("label").alias("old"), F.least("label", "heard").alias("label")))
        labels = checkpointed(new.join(new.select(F.col("v").alias("label"), F.col("label").alias("next")), "label").select("v", "old", F.col("next").alias("label")))
        if labels.where("old != label").isEmpty():
            return labels.select("v", "label")
        labels = labels.select("v", "label")
