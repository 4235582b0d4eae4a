"""Connected components of a graph of links, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from framestore.session import delete_path, stage


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of `links` (columns a, b of one type): the smallest node it is connected with.

    Labels spread along the links and then jump to the label of their label, so long
    chains need few rounds. Each round is written to the shared folder, which cuts
    the lineage; a node with very many links is one partial minimum per task.
    """
    spark = links.sparkSession
    both = links.where("a <> b").select("a", "b").union(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    both, _ = stage(both.distinct(), "links")
    labels, path = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("jumped"))
        nearer, new_path = stage(
            spread.join(jump, "low").select("node", "label", F.least("low", "jumped").alias("next")), "labels"
        )
        changed = nearer.where("label <> next").limit(1).count()
        delete_path(spark, path)
        labels, path = nearer.select("node", F.col("next").alias("label")), new_path
        if not changed:
            return labels
