"""Intermediate tables in the shared folder: they cut lineage, survive lost executors and have a known size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import scratch_path


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
