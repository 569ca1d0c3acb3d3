"""Staging: a feed's text columns, renamed and cast, plus the time the rows were loaded."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyloom.functions import cast_text, is_castable, literal, quoted, records, utc_instant

LOADED_AT = "_loaded_at"

# target column -> (source column, kind)
StagingSpec = Mapping[str, tuple[str, str]]


def staging_spec(table: str) -> dict[str, tuple[str, str]]:
    """A spec from lines of ``target source kind``."""
    rows = (line.split() for line in table.strip().splitlines())
    return {target: (source, kind) for target, source, kind in rows}


def load_time(df: DataFrame, loaded_at: str | None = None) -> str:
    """The load time of a staged row: given, carried by the feed, or the time of the query."""
    if loaded_at is not None:
        return loaded_at
    return LOADED_AT if LOADED_AT in df.columns else utc_instant("current_timestamp()")


def stage(df: DataFrame, spec: StagingSpec, loaded_at: str | None = None) -> DataFrame:
    """The spec's columns in order, cast, and the load time. Source columns not listed are dropped."""
    kinds = dict(df.dtypes)
    columns = []
    for target, (source, kind) in spec.items():
        if kinds.get(source, "string") == "string":
            sql = cast_text(quoted(source), kind)
        else:
            sql = f"cast({quoted(source)} as {'timestamp_ntz' if kind == 'timestamp' else kind})"
        columns.append(f"{sql} as {quoted(target)}")
    return df.selectExpr(*columns, f"{load_time(df, loaded_at)} as {LOADED_AT}")


def castability(df: DataFrame, spec: StagingSpec) -> DataFrame:
    """Per source column of a raw text frame: rows with a value, and how many would not cast.

    One scan and one aggregation for all columns, to be run before staging, which stops at the
    first bad value.
    """
    aggregates, rows = [], []
    for i, (source, kind) in enumerate(spec.values()):
        column = quoted(source)
        aggregates.append(f"count({column}) as p{i}")
        aggregates.append(f"count_if(not {is_castable(column, kind)}) as b{i}")
        rows.append(
            {
                "column_name": literal(source),
                "declared_type": literal(kind),
                "present": f"p{i}",
                "not_castable": f"b{i}",
            }
        )
    return df.selectExpr(*aggregates).selectExpr(records(rows))
