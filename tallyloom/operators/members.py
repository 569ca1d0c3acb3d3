"""How many different members a group has, from bitmaps that add up over any coarser group.

Members get numbers once; a group holds a bitmap for each range of numbers in which it has a member. A bitmap
has 4 KB, however many rows made it, and those of hours or months are united by OR: counts of a longer
period or a coarser group don't read the usage again, and no group is ever an array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import quoted
from tallyloom.session import scratch_path


def numbered(spark: SparkSession, df: DataFrame, member: str) -> DataFrame:
    """The distinct values of a column with a number each, written once so that numbers stay.

    Numbers are dense within the ranges of Spark's partitions, which keeps bitmaps few.
    """
    path = scratch_path(spark, f"members-{member}")
    values = df.select(member).where(f"{quoted(member)} is not null").distinct()
    values.withColumn("_number", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def member_bitmaps(df: DataFrame, numbers: DataFrame, group: Sequence[str], member: str) -> DataFrame:
    """The group's columns, ``bucket`` and ``bits``: one bitmap per group and range of 32,768 numbers.

    Null members are left out; a null in the group's columns is a value like others.
    """
    placed = df.where(f"{quoted(member)} is not null").join(numbers, member)
    return (
        placed.selectExpr(
            *[quoted(name) for name in group],
            "bitmap_bucket_number(_number) as bucket",
            "bitmap_bit_position(_number) as place",
        )
        .groupBy(*group, "bucket")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
    )


def united(bitmaps: DataFrame, group: Sequence[str]) -> DataFrame:
    """The bitmaps of a coarser group, or of several tables' rows together."""
    return bitmaps.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def member_counts(bitmaps: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """The number of different members of each group, as the column ``name``."""
    counted = united(bitmaps, group).select(*group, F.bitmap_count("bits").alias("_n"))
    return counted.groupBy(*group).agg(F.sum("_n").alias(name))
