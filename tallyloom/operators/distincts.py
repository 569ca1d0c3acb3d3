"""Counts of distinct values for many checks at once.

Each row gives a pair (check, hash of the value) for every check; pairs are made distinct together, in one
scan and one shuffle that is keyed by the hash too, so no check is hot. A sketch of every check in one
aggregation can go first: where its estimate is far from what is expected the check fails without
an exact count, which spares the shuffle of columns with very many values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import literal, quoted, record, records
from tallyloom.operators.checks import Check

# An estimate beyond this factor of what is expected is far; the sketch's own error is below 2 % (one sigma).
FAR = 2.0

# The columns of the report.
REPORT = (
    "column_name string, other string, expected bigint, distinct_count bigint, violations bigint, status string"
)


def _value(check: Check) -> str:
    """The value that counts: of ``other``, in rows with a value in the check's column."""
    return f"if({quoted(check.column)} is not null, {quoted(check.params['other'])}, null)"


def _hash(value: str) -> str:
    """128 bits that stand for a value."""
    return f"struct(xxhash64({value}) as one, xxhash64('two', {value}) as two)"


def distinct_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``check_no``, the check's place, and its exact ``distinct_count``, also where that is 0."""
    pairs = ", ".join(
        f"if(({_value(c)}) is null, null, {record({'check_no': str(i), 'hash': _hash(_value(c))})})"
        for i, c in enumerate(checks)
    )
    if not checks:
        return df.sparkSession.createDataFrame([], "check_no int, distinct_count bigint")
    found = (
        df.selectExpr(f"inline(array_compact(array({pairs})))")
        .selectExpr("check_no", "hash.one as one", "hash.two as two")
        .distinct()
        .groupBy("check_no")
        .agg(F.count("*").alias("n"))
    )
    asked = df.sparkSession.range(len(checks)).selectExpr("cast(id as int) as check_no")
    return asked.join(found, "check_no", "left").selectExpr("check_no", "coalesce(n, 0L) as distinct_count")


def estimates(df: DataFrame, checks: Sequence[Check]) -> list[int]:
    """An estimate of each check's count, from one scan and one aggregation of sketches."""
    sketches = []
    for i, check in enumerate(checks):
        value = _value(check)
        sketch = f"hll_sketch_agg(xxhash64({value}), 14) filter (where ({value}) is not null)"
        sketches.append(f"coalesce(hll_sketch_estimate({sketch}), 0L) as n{i}")
    return list(df.selectExpr(*sketches).first())


def is_far(estimate: int, expected: int) -> bool:
    return estimate > FAR * expected + 1 or expected > FAR * estimate + 1


def distinct_report(df: DataFrame, checks: Sequence[Check], gate: bool = True) -> DataFrame:
    """One row per check: its columns, ``expected``, ``distinct_count``, ``violations`` (0 or 1) and ``status``.

    With ``gate`` a check whose estimate is far has no exact count: ``distinct_count`` is null, and it is
    violated. Without, all are counted, in a single scan.
    """
    if not checks:
        return df.sparkSession.createDataFrame([], REPORT)
    far = set()
    if gate:
        guessed = estimates(df, checks)
        far = {i for i, c in enumerate(checks) if is_far(guessed[i], c.params["expected"])}
    near = [i for i in range(len(checks)) if i not in far]
    counted = distinct_counts(df, [checks[i] for i in near])
    entries = [
        {
            "own_no": str(near.index(i) if i in near else -1),
            "column_name": literal(c.column),
            "other": literal(c.params["other"]),
            "expected": f"{c.params['expected']}L",
            "severity": literal(c.severity),
        }
        for i, c in enumerate(checks)
    ]
    asked = df.sparkSession.range(1).selectExpr(records(entries))
    return asked.join(counted, F.col("own_no") == F.col("check_no"), "left").selectExpr(
        "column_name",
        "other",
        "expected",
        "distinct_count",
        "if(distinct_count <=> expected, 0L, 1L) as violations",
        "if(distinct_count <=> expected, 'pass', severity) as status",
    )
