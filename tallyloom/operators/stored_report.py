"""Check reports of a partitioned table that read only the folders that have changed.

Violations are counted per folder and kept with a mark of the folder's files. A later run lists the files,
counts the folders whose mark is new, and adds up what it has. Nothing is overwritten: counts are
appended and found again by folder, mark and check, so a lost run costs only its own work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import literal, records
from tallyloom.operators.checks import Check
from tallyloom.operators.report import distinct_part, empty_report
from tallyloom.sources.upsert import FOLDERS, folder_values, in_folders, table_exists

# The columns of the kept counts.
KEPT = "folder string, mark string, check_id string, violations bigint"


def folder_marks(spark: SparkSession, path: str, folders: Sequence[str] = FOLDERS) -> DataFrame:
    """Each folder of the table and a mark that changes with the names, sizes and times of its files."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    depth = "[^/]+/" * len(folders)
    return (
        found.selectExpr(
            f"regexp_extract(path, '({depth})[^/]+$', 1) as folder",
            "concat_ws(':', path, length, unix_micros(modificationTime)) as file",
        )
        .groupBy("folder")
        .agg(F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list("file"))), 256).alias("mark"))
    )


def kept_counts(spark: SparkSession, kept: str) -> DataFrame:
    return spark.read.schema(KEPT).parquet(kept) if table_exists(spark, kept) else spark.createDataFrame([], KEPT)


def _check_id(check: Check, kind: str) -> str:
    text = repr((check.kind, check.column, sorted(check.params.items(), key=repr), kind))
    return hashlib.sha256(text.encode()).hexdigest()[:20]


def count_folders(df: DataFrame, checks: Sequence[Check], ids: Sequence[str], folders: Sequence[str]) -> DataFrame:
    """Violations of each check in each folder: one scan and one aggregation."""
    counts, rows = [F.count("*").alias("total")], []
    for i, check in enumerate(checks):
        broken = check.broken(df.schema)
        if broken is not None:
            counts.append(F.expr(f"count_if({broken})").alias(f"n{i}"))
        rows.append({"check_id": literal(ids[i]), "violations": "0L" if broken is None else f"n{i}"})
    return df.groupBy(*folders).agg(*counts).selectExpr(*folders, records(rows))


def report_changed(
    spark: SparkSession, path: str, kept: str, checks: Sequence[Check], folders: Sequence[str] = FOLDERS
) -> tuple[DataFrame, list[str]]:
    """The table's report, as ``report`` gives it, and the folders that were read for it.

    A folder of whose files one was added, removed or rewritten is read again; so are all, for a check that
    is new or has other parameters. Names of folders come to the driver. Distinct counts don't add up
    over folders; they read their columns of the whole table each time.
    """
    table = spark.read.parquet(path)
    rows = [check for check in checks if not check.is_aggregate]
    ids = [_check_id(check, table.schema[check.column].dataType.simpleString()) for check in rows]
    marks = folder_marks(spark, path, folders)
    before = kept_counts(spark, kept)
    read: list[str] = []
    if ids:
        needed = marks.selectExpr("*", records([{"check_id": literal(i)} for i in ids]))
        missing = needed.join(before, ["folder", "mark", "check_id"], "left_anti")
        changed = sorted(tuple(r) for r in missing.select("folder", "mark").distinct().collect())
        read = [folder for folder, _ in changed]
    if read:
        values = [folder_values(folder) for folder in read]
        text = table.withColumns({name: table[name].cast("string") for name in folders})
        counted = count_folders(text.where(in_folders(values, folders)), rows, ids, folders)
        labels = spark.createDataFrame(
            [(*of, *named) for of, named in zip(values, changed, strict=True)],
            ", ".join([*[f"{name}_ string" for name in folders], "folder string", "mark string"]),
        )
        same = [counted[name].eqNullSafe(labels[f"{name}_"]) for name in folders]
        counted.join(labels, same).select(*before.columns).write.mode("append").parquet(kept)
        before = kept_counts(spark, kept)
    parts = []
    if ids:
        counts = (
            before.join(marks, ["folder", "mark"], "left_semi")
            .groupBy("folder", "check_id")
            .agg(F.max("violations").alias("violations"))
            .groupBy("check_id")
            .agg(F.sum("violations").alias("n"))
        )
        entries = [
            {
                "check_id": literal(ids[i]),
                "column_name": literal(check.column),
                "check_name": literal(check.kind),
                "severity": literal(check.severity),
                "tags": literal(",".join(check.tags)),
            }
            for i, check in enumerate(rows)
        ]
        asked = spark.range(1).selectExpr(records(entries))
        parts.append(
            asked.join(counts, "check_id", "left").selectExpr(
                "column_name",
                "check_name",
                "severity",
                "tags",
                "coalesce(n, 0L) as violations",
                "if(coalesce(n, 0L) = 0, 'pass', severity) as status",
            )
        )
    aggregates = [check for check in checks if check.is_aggregate]
    if aggregates:
        parts.append(distinct_part(table, aggregates))
    if not parts:
        return empty_report(spark), read
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])), read
