"""A set of checks as one job: a report with a count per check, or the rows split into good and bad."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.functions import literal, record, records
from tallyloom.operators.checks import Check
from tallyloom.operators.distincts import distinct_counts

FAILED = "_failed"
QUARANTINED = "_quarantined"


def select_checks(
    checks: Iterable[Check],
    *,
    tags: Iterable[str] = (),
    severity: str | None = None,
    columns: Iterable[str] = (),
) -> list[Check]:
    """The checks that carry all the tags, and match the severity and one of the columns if given."""
    wanted, named = set(tags), set(columns)
    return [
        check
        for check in checks
        if wanted <= set(check.tags)
        and (severity is None or check.severity == severity)
        and (not named or check.column in named)
    ]


def report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Violations and status of each check, from one scan and one aggregation.

    Checks that the schema already decides cost nothing. All distinct counts are taken in one more scan.
    Without checks the report is empty.
    """
    if not checks:
        return empty_report(df.sparkSession)
    schema = df.schema
    counts, rows = ["count(*) as total"], []
    for i, check in enumerate(checks):
        if not check.is_aggregate:
            broken = check.broken(schema)
            if broken is not None:
                counts.append(f"count_if({broken}) as n{i}")
            rows.append(_entry(check, "0L" if broken is None else f"n{i}"))
    parts = [df.selectExpr(*counts).selectExpr(records(rows))] if rows else []
    aggregates = [check for check in checks if check.is_aggregate]
    if aggregates:
        parts.append(distinct_part(df, aggregates))
    return reduce(DataFrame.unionByName, parts)


def distinct_part(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The report of distinct counts: one violation where a count is not the expected one."""
    entries = [record(_entry(c, f"if(n = {c.params['expected']}, 0L, 1L)")) for c in checks]
    counted = distinct_counts(df, checks).selectExpr("check_no", "distinct_count as n")
    return counted.selectExpr(f"get(array({', '.join(entries)}), check_no) as e").select("e.*")


# The columns of a report.
REPORT = "column_name string, check_name string, severity string, tags string, violations bigint, status string"


def empty_report(spark: SparkSession, *before: str) -> DataFrame:
    """A report without rows; ``before`` are further columns in front, as DDL."""
    return spark.createDataFrame([], ", ".join([*before, REPORT]))


def _entry(check: Check, found: str) -> dict[str, str]:
    return {
        "column_name": literal(check.column),
        "check_name": literal(check.kind),
        "severity": literal(check.severity),
        "tags": literal(",".join(check.tags)),
        "violations": found,
        "status": f"if({found} = 0, 'pass', {literal(check.severity)})",
    }


def with_failures(df: DataFrame, checks: Iterable[Check], severity: str = "error") -> DataFrame:
    """Adds the names of the checks each row breaks, counting checks of one severity."""
    schema = df.schema
    marks = []
    for check in checks:
        if check.severity == severity and not check.is_aggregate:
            broken = check.broken(schema)
            if broken is not None:
                marks.append(f"if({broken}, {literal(check.name)}, null)")
    failed = f"array_compact(array({', '.join(marks)}))" if marks else "cast(array() as array<string>)"
    return df.selectExpr("*", f"{failed} as {FAILED}")


def quarantine(
    df: DataFrame, checks: Iterable[Check], severity: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """Rows that may go on, and rows held back together with the checks they break."""
    marked = with_failures(df, checks, severity)
    return marked.where(f"size({FAILED}) = 0").drop(FAILED), marked.where(f"size({FAILED}) > 0")


def write_quarantine(
    df: DataFrame, checks: Iterable[Check], path: str, severity: str = "error"
) -> None:
    """Both sides of the split in one pass over the rows, as the two partitions of one table."""
    marked = with_failures(df, checks, severity).selectExpr("*", f"size({FAILED}) > 0 as {QUARANTINED}")
    marked.write.partitionBy(QUARANTINED).mode("errorifexists").parquet(path)


def read_quarantine(
    spark: SparkSession, path: str, held: bool, schema: T.StructType | None = None
) -> DataFrame:
    """One side of a written split; the other side's files are not opened."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).where(f"{QUARANTINED} = {literal(held)}").drop(QUARANTINED)
