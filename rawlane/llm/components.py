"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlane.session import work_path


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges`` (``a, b``, longs).

    Labels fall to the smallest one among a node's neighbours and then to that label's own label, which halves distances;
    this ends when nothing falls any more. Each round is a written table in the shared folder, so lineage stays short and
    a lost executor costs one round at most. Minima are taken with partial aggregation, so a hub is no hot spot.
    """
    spark, folder = edges.sparkSession, work_path(edges.sparkSession, "components")
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct()
    both.write.parquet(f"{folder}/edges")
    both = spark.read.parquet(f"{folder}/edges")
    both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")).write.parquet(f"{folder}/0")
    labels, turn = spark.read.parquet(f"{folder}/0"), 0
    while True:
        turn += 1
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        fallen = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("component").alias("further"))
        fallen = fallen.join(jump, "label", "left").select("node", "before", F.least("label", F.coalesce("further", "label")).alias("component"))
        fallen.write.parquet(f"{folder}/{turn}")
        fallen = spark.read.parquet(f"{folder}/{turn}")
        labels = fallen.select("node", "component")
        if fallen.where("component < before").limit(1).count() == 0:
            return labels
