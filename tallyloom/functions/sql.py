"""Names, values and records as SQL text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def quoted(name: str) -> str:
    """A column name, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: object) -> str:
    """A Python value as a literal; text may hold quotes, backslashes and line breaks."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"double('{value!r}')"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"no literal for {value!r}")


def listed(values: Iterable[object]) -> str:
    return ", ".join(literal(value) for value in values)


def record(fields: Mapping[str, str]) -> str:
    """A struct of named expressions."""
    return "struct(" + ", ".join(f"{sql} as {quoted(name)}" for name, sql in fields.items()) + ")"


def records(rows: Iterable[Mapping[str, str]]) -> str:
    """A table of a few rows, made from the single row it is selected from."""
    return "inline(array(" + ", ".join(record(row) for row in rows) + "))"


def column_of(spark: SparkSession, name: str, values: Iterable[object]) -> DataFrame:
    """A one-column table of a few values, whose size Spark knows when it plans."""
    rows = [f"({literal(value)})" for value in values]
    some = ", ".join(rows) or "(cast(null as string))"
    df = spark.sql(f"select {quoted(name)} from values {some} as t({quoted(name)})")
    return df if rows else df.where("false")
