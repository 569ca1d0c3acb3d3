"""What there is to read: files under a glob, tables and their sizes, columns and their ranges."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.functions import literal, quoted, records, utc_instant


def file_inventory(spark: SparkSession, pattern: str) -> DataFrame:
    """Path, size and modification time of every file that matches; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(pattern)
        .selectExpr(
            "path as file_path",
            "length as file_size",
            f"{utc_instant('modificationTime')} as modified_at",
        )
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows, size and modification time of each file behind a file-based frame."""
    file = ("file_path", "file_name", "file_size")
    return (
        df.selectExpr(
            *[f"_metadata.{name} as {name}" for name in file],
            "_metadata.file_modification_time as written",
        )
        .groupBy(*file, "written")
        .count()
        .selectExpr(*file, "count as rows", f"{utc_instant('written')} as modified_at")
    )


def dataset_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, row count and column count of each table; the counts of all tables run as one job."""
    counted = [
        df.selectExpr("count(*) as rows").selectExpr(
            f"{literal(name)} as table_name", "rows", f"{len(df.columns)}L as columns"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def catalog_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """The tables and views of the catalog, ready for ``dataset_inventory``."""
    prefix = f"{quoted(database)}." if database else ""
    return {
        found.name: spark.table(quoted(found.name) if found.isTemporary else prefix + quoted(found.name))
        for found in spark.catalog.listTables(database)
    }


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type and nullability of each column, with its NULL count and its range as text.

    One scan and one aggregation for all columns. Types without an order have no range.
    """
    aggregates, rows = [], []
    for i, field in enumerate(df.schema):
        column = quoted(field.name)
        ordered = not isinstance(field.dataType, (T.MapType, T.VariantType, T.BinaryType))
        aggregates.append(f"count_if({column} is null) as nulls{i}")
        for edge in ("min", "max"):
            value = f"cast({edge}({column}) as string)" if ordered else "cast(null as string)"
            aggregates.append(f"{value} as {edge}{i}")
        rows.append(
            {
                "column_name": literal(field.name),
                "data_type": literal(field.dataType.simpleString()),
                "is_nullable": literal("YES" if field.nullable else "NO"),
                "null_rows": f"nulls{i}",
                "min_value": f"min{i}",
                "max_value": f"max{i}",
            }
        )
    return df.selectExpr(*aggregates).selectExpr(records(rows))


def column_coverage(df: DataFrame) -> DataFrame:
    """Position and name of each column, and the rows that have a value in it."""
    counts = df.selectExpr(*[f"count({quoted(name)}) as n{i}" for i, name in enumerate(df.columns)])
    return counts.selectExpr(
        records(
            {"position": f"{i + 1}L", "column_name": literal(name), "filled_rows": f"n{i}"}
            for i, name in enumerate(df.columns)
        )
    )
