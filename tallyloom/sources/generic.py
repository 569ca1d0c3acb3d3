"""Feeds that already have canonical columns, as CSV and optionally Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.functions import literal, quoted
from tallyloom.operators.staging import LOADED_AT, load_time
from tallyloom.sources.files import read_csv, read_parquet, with_load_time

# Fixed value: the specification version stamped on generic feeds.
SPEC_VERSION = "1.4"
VERSION_COLUMN = "_focus_version"


def union_by_name(text: DataFrame, typed: DataFrame) -> DataFrame:
    """Rows of both frames, matched by column name; a column that one side lacks is NULL there.

    Where the sides disagree on a type the column becomes text, as the CSV side already is.
    """
    kinds = dict(text.dtypes)
    aligned = typed.selectExpr(
        *[
            quoted(name)
            if kinds.get(name, kind) == kind
            else f"cast({quoted(name)} as string) as {quoted(name)}"
            for name, kind in typed.dtypes
        ]
    )
    return text.unionByName(aligned, allowMissingColumns=True)


def stage_generic(
    text: DataFrame,
    typed: DataFrame | None = None,
    loaded_at: str | None = None,
    version: str = SPEC_VERSION,
) -> DataFrame:
    """The feed's own columns, then load time and specification version."""
    both = text if typed is None else union_by_name(text, typed)
    return both.selectExpr(
        *[quoted(name) for name in both.columns if name != LOADED_AT],
        f"{load_time(both, loaded_at)} as {LOADED_AT}",
        f"{literal(version)} as {VERSION_COLUMN}",
    )


def read_generic(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    typed = None
    if parquet_path:
        typed = with_load_time(read_parquet(spark, parquet_path, schema=schema))
    return stage_generic(with_load_time(read_csv(spark, csv_path)), typed)
