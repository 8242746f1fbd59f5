"""Connected groups of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import delete, saved


def connected_groups(edges: DataFrame) -> DataFrame:
    """(node, group): the least node that each node of ``edges`` (u, v) reaches.

    Each round gives a node the least label of its neighbours and then the label of that
    node, so distances double; every round is written, and rounds end when none changes a label.
    """
    spark = edges.sparkSession
    both = edges.where("u <> v").select("u", "v").unionByName(edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both, paths = saved(both)
    labels, at = saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("group")).withColumnRenamed("u", "node"))
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("group").alias("near"))
        new = labels.join(near, labels["node"] == near["u"]).select("node", "group", F.least("group", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("group").alias("far"))
        new, path = saved(new.join(jump, "new", "left").select("node", F.col("group").alias("old"), F.least("new", F.coalesce("far", "new")).alias("group")))
        changed = new.where("group <> old").limit(1).count()
        delete(spark, at)
        labels, at = new.drop("old"), path
        if not changed:
            delete(spark, paths)
            return labels
