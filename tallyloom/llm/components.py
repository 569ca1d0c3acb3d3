"""Connected components by repeated minimum labels and pointer jumping; labels stay in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.written import written


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node of ``one``, ``two``.

    Each round takes the least label of the neighbours, combined before the shuffle, and then the label
    of that label. Rounds end when no label moves. Each round's labels are written to the shared folder.
    """
    both = edges.select("one", "two").union(edges.select("two", "one")).where("one <> two").distinct()
    both = written(spark, both, "edges")
    labels = both.groupBy(F.col("one").alias("node")).agg(F.min("two").alias("label"))
    labels = written(spark, labels.withColumn("label", F.least("node", "label")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "two"), "two")
            .groupBy(F.col("one").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        root = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        moved = lower.join(root, "label").select("node", F.least("label", "root").alias("label"), "old")
        moved = written(spark, moved, "labels")
        labels = moved.select("node", "label")
        if moved.where("label < old").limit(1).isEmpty():
            return labels
