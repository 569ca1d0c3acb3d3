"""Column profiles that add up: sketches of each column per month or folder, merged into longer periods.

All sketches of all columns come from one scan and one aggregation, of a few KB per column and group
whatever the number of rows. Those of several groups merge into one of the same size, so a year's
profile doesn't read the months again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import literal, quoted, records
from tallyloom.operators.checks import Check
from tallyloom.operators.distincts import distinct_counts

LOG_NOMINAL = 12  # a theta sketch of 4,096 entries: 1.6 % standard error
QUANTILE_K = 200  # ranks within 1.7 % with 99 % confidence
TOP_TRACKED = 1_000
TOP_LENGTH = 200  # longer texts are told apart by their beginning and a hash
# Stated bounds: three standard errors of the distinct count, and the rank error with some room.
DISTINCT_BOUND = 0.05
RANK_BOUND = 0.025

_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_ORDERED = (T.NumericType, *_TIMES, T.BooleanType)


def as_number(column: str, kind: T.DataType) -> str | None:
    """The column as a double, times in seconds; None where it has no order of this sort."""
    if isinstance(kind, _TIMES):
        return f"cast(unix_micros(cast({column} as timestamp)) as double) / 1e6D"
    return f"cast({column} as double)" if isinstance(kind, _ORDERED) else None


def _item(column: str, kind: T.DataType) -> str:
    """The column as a short text for the list of frequent items."""
    text = column if isinstance(kind, T.StringType) else f"to_json(struct({column} as v))"
    if isinstance(kind, (T.NumericType, *_TIMES, T.BooleanType)):
        text = f"cast({column} as string)"
    long = f"left({text}, {TOP_LENGTH}) || '…' || hex(xxhash64({text}))"
    return f"if(length({text}) > {TOP_LENGTH}, {long}, {text})"


def column_sketches(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """A row per group and column: ``rows``, ``nulls`` and the sketches ``distincts``, ``quantiles``, ``top``.

    Quantiles are of numbers, times and truth values; other columns have none. NaN is a value for the distinct
    count and no value for quantiles. Nulls are in no sketch. A frame without rows and ``by`` has rows 0.
    """
    chosen = [df.schema[name] for name in (columns or [c for c in df.columns if c not in by])]
    aggregates, rows = ["count(*) as total"], []
    for i, field in enumerate(chosen):
        column = quoted(field.name)
        number = as_number(column, field.dataType)
        aggregates += [
            f"count_if({column} is null) as nulls{i}",
            f"theta_sketch_agg(xxhash64({column}), {LOG_NOMINAL}) filter (where {column} is not null) as d{i}",
            f"approx_top_k_accumulate({_item(column, field.dataType)}, {TOP_TRACKED})"
            f" filter (where {column} is not null) as t{i}",
        ]
        if number:
            aggregates.append(
                f"kll_sketch_agg_double({number}, {QUANTILE_K})"
                f" filter (where {column} is not null and not isnan({number})) as q{i}"
            )
        rows.append(
            {
                "column_name": literal(field.name),
                "rows": "total",
                "nulls": f"nulls{i}",
                "distincts": f"d{i}",
                "quantiles": f"q{i}" if number else "cast(null as binary)",
                "top": f"t{i}",
            }
        )
    grouped = df.groupBy(*by).agg(*[F.expr(a) for a in aggregates])
    return grouped.selectExpr(*[quoted(name) for name in by], records(rows))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups, or of several tables' sketches together."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.expr("theta_union_agg(distincts)").alias("distincts"),
        F.expr("kll_merge_agg_double(quantiles)").alias("quantiles"),
        F.expr(f"approx_top_k_combine(top, {TOP_TRACKED})").alias("top"),
    )


def described(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), items: int = 3) -> DataFrame:
    """Estimates from sketches: ``distinct_estimate``, the values at some quantiles, and frequent items with counts."""
    ranks = ", ".join(f"{q}D" for q in quantiles)
    kept = [name for name in sketches.columns if name not in ("distincts", "quantiles", "top")]
    some = "coalesce(kll_sketch_get_n_double(quantiles), 0L) > 0"
    return sketches.selectExpr(
        *[quoted(name) for name in kept],
        "coalesce(theta_sketch_estimate(distincts), 0L) as distinct_estimate",
        f"if({some}, kll_sketch_get_quantile_double(quantiles, array({ranks})), null) as at_quantiles",
        f"approx_top_k_estimate(top, {items}) as frequent",
    )


def measured_errors(df: DataFrame, estimates: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per column the relative error of the distinct count and the largest error of a quantile's rank.

    Reads the frame once more for the distinct counts and once for the ranks. A quantile stands anywhere
    among values equal to it, so its rank is wrong by the distance to that range.
    """
    found = {r.column_name: r for r in estimates.select("column_name", "at_quantiles").collect()}
    names = list(found)
    checks = [Check("distinct_count", name, params={"other": name, "expected": 0}) for name in names]
    aggregates, rows = [], []
    for i, name in enumerate(names):
        number = as_number(quoted(name), df.schema[name].dataType)
        errors = []
        for k, value in enumerate(found[name].at_quantiles or []):
            aggregates += [f"count_if({number} < {literal(value)}) as b{i}_{k}", f"count_if({number} <= {literal(value)}) as u{i}_{k}"]
            rank = f"{quantiles[k]}D * count{i}"
            errors.append(f"greatest(b{i}_{k} - {rank}, {rank} - u{i}_{k}, 0.0D) / count{i}")
        aggregates.append(f"count({quoted(name)}) as count{i}")
        worst = f"greatest({', '.join(errors)}, 0.0D)" if errors else "cast(null as double)"
        rows.append({"place": str(i), "column_name": literal(name), "rank_error": worst})
    ranks = df.selectExpr(*aggregates).selectExpr(records(rows))
    exact = distinct_counts(df, checks)
    joined = ranks.join(exact, F.col("place") == F.col("check_no")).join(
        estimates.select("column_name", "distinct_estimate"), "column_name"
    )
    return joined.selectExpr(
        "column_name",
        "abs(distinct_estimate - distinct_count) / greatest(distinct_count, 1L) as distinct_error",
        "rank_error",
    )
