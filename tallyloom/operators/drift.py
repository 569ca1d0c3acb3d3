"""Columns and payload keys that a manifest does not know."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import column_of, literal, quoted, records
from tallyloom.model import Manifest


def unexpected_columns(df: DataFrame, manifest: Manifest) -> list[str]:
    return [name for name in df.columns if name not in manifest.known]


def missing_columns(df: DataFrame, manifest: Manifest) -> list[str]:
    return sorted(manifest.allowed - set(df.columns))


def failure_reason(column: str) -> str:
    # Fixed value: the wording of a schema failure.
    return f"UNEXPECTED COLUMN: {column} — add to manifest allowed or ignored list"


def schema_failures(df: DataFrame, manifest: Manifest) -> DataFrame:
    """One row per unexpected column: the reason, and how many rows carry a value in it.

    The column names come from the schema; the counts are one aggregation over those columns only.
    """
    found = unexpected_columns(df, manifest)
    if not found:
        return df.sparkSession.createDataFrame(
            [], "column_name string, failure_reason string, rows_with_value bigint"
        )
    counts = df.selectExpr(*[f"count({quoted(name)}) as n{i}" for i, name in enumerate(found)])
    return counts.selectExpr(
        records(
            {
                "column_name": literal(name),
                "failure_reason": literal(failure_reason(name)),
                "rows_with_value": f"n{i}",
            }
            for i, name in enumerate(found)
        )
    )


def manifest_frame(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """The known names as a table; as short as the manifest, so safe to broadcast."""
    return column_of(spark, "key", sorted(manifest.known))


# Stands for a value that is not a JSON object, in the place of a key.
UNREADABLE = "(unreadable)"


def payload_key_drift(df: DataFrame, payload: str, manifest: Manifest) -> DataFrame:
    """Top-level keys of a JSON column that the manifest does not know, with the rows that have them.

    Values that are present but no JSON object count under ``(unreadable)``.
    """
    found = f"array_distinct(json_object_keys({quoted(payload)}))"
    keys = df.where(f"{quoted(payload)} is not null").selectExpr(
        f"explode(coalesce({found}, array({literal(UNREADABLE)}))) as key"
    )
    known = manifest_frame(df.sparkSession, manifest)
    return (
        keys.join(known, "key", "left_anti").groupBy("key").agg(F.count("*").alias("rows_with_key"))
    )
