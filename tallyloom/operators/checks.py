"""Data checks. A check is a condition that picks out the rows which break it.

A missing value breaks nothing but ``not_null``. Type checks look at the schema: a column of the right
type cannot break them, a column of the wrong type breaks them wherever it has a value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyloom.functions import (
    is_castable,
    is_date_time,
    is_decimal,
    is_json,
    is_key_value,
    listed,
    literal,
    quoted,
)
from tallyloom.functions.text import matches


@dataclass(frozen=True)
class Check:
    """One check on one column, or on ``column`` and the columns named in ``params``."""

    kind: str
    column: str
    severity: str = "error"
    tags: tuple[str, ...] = ()
    params: dict = field(default_factory=dict, hash=False)

    def __post_init__(self) -> None:
        if self.kind not in CONDITIONS and not self.is_aggregate:
            raise ValueError(f"unknown check {self.kind!r}")

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"

    @property
    def is_aggregate(self) -> bool:
        return self.kind == "distinct_count"

    def columns(self) -> list[str]:
        """The columns the check reads."""
        others = [self.params[key] for key in ("other", "factor", "result") if key in self.params]
        return [self.column, *others]

    def broken(self, schema: T.StructType) -> str | None:
        """Where a row breaks the check; None when the schema alone shows that no row can."""
        return CONDITIONS[self.kind](_Subject(self, schema))


class _Subject:
    """The column under check, with its type at hand."""

    def __init__(self, check: Check, schema: T.StructType) -> None:
        self.params = check.params
        self.value = quoted(check.column)
        self.type = schema[check.column].dataType

    @property
    def text(self) -> str:
        is_text = isinstance(self.type, T.StringType)
        return self.value if is_text else f"cast({self.value} as string)"

    @property
    def number(self) -> str:
        return f"cast({self.value} as double)"

    def param(self, name: str) -> str:
        return literal(self.params[name])

    def other(self, name: str, kind: str) -> str:
        return f"cast({quoted(self.params[name])} as {kind})"

    def type_within(self, *family: type) -> str | None:
        return None if isinstance(self.type, family) else f"{self.value} is not null"


_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _date_time_format(s: _Subject) -> str | None:
    """The text form has whole seconds; a typed value can only fail on a fraction."""
    if isinstance(s.type, T.DateType):
        return None
    if isinstance(s.type, (T.TimestampType, T.TimestampNTZType)):
        return f"unix_micros(cast({s.value} as timestamp)) % 1000000 != 0"
    return f"not {is_date_time(s.text)}"


def _json_format(s: _Subject) -> str | None:
    if isinstance(s.type, (T.StructType, T.VariantType, T.ArrayType, T.MapType)):
        return None
    return f"not {is_json(s.text)}"


def _multiplied(s: _Subject) -> str:
    difference = f"{s.number} * {s.other('factor', 'double')} - {s.other('result', 'double')}"
    return f"abs({difference}) > {s.param('tolerance')}"


def _outside(s: _Subject) -> str:
    return f"{s.value} not in ({listed(s.params['values'])})"


# The comparators.
_COMPARATORS = (">", "<", ">=", "<=", "==", "!=")


def _compared(s: _Subject) -> str:
    """The comparator does not hold. ``legacy`` reports rows where ``==`` or ``!=`` does hold."""
    comparator = s.params["comparator"]
    if comparator not in _COMPARATORS:
        raise ValueError(f"unknown comparator {comparator!r}")
    kind = "string" if comparator in ("==", "!=") else "double"
    holds = f"(cast({s.value} as {kind}) {comparator} {s.other('other', kind)})"
    return holds if kind == "string" and s.params.get("legacy") else f"not {holds}"


CONDITIONS: dict[str, Callable[[_Subject], str | None]] = {
    "type_string": lambda s: s.type_within(T.StringType),
    "type_decimal": lambda s: s.type_within(T.NumericType),
    "type_datetime": lambda s: s.type_within(*_TIMES),
    "type_json": lambda s: s.type_within(T.StringType, T.StructType, T.VariantType),
    "format_string": lambda s: s.type_within(T.StringType),
    "format_numeric": lambda s: s.type_within(T.NumericType),
    "format_datetime": _date_time_format,
    "format_currency": lambda s: s.type_within(T.StringType),
    "format_unit": lambda s: s.type_within(T.StringType),
    "format_key_value": lambda s: f"not {is_key_value(s.text)}",
    "format_json": _json_format,
    "regex_match": lambda s: f"not {matches(s.text, s.params['pattern'])}",
    "national_currency": _outside,
    "accepted_values": _outside,
    "greater_or_equal": lambda s: f"{s.number} < {s.param('threshold')}",
    "less_or_equal": lambda s: f"{s.number} > {s.param('threshold')}",
    "decimal_value": lambda s: (
        None if isinstance(s.type, T.NumericType) else f"not {is_decimal(s.text)}"
    ),
    "castable": lambda s: f"not {is_castable(s.text, s.params['to'])}",
    "column_equality": lambda s: f"cast({s.value} as string) != {s.other('other', 'string')}",
    "multiplication_equals": _multiplied,
    "string_ends_with": lambda s: f"not endswith({s.text}, {s.param('value')})",
    "column_comparison": _compared,
    "not_null": lambda s: f"{s.value} is null",
}


def violations(df: DataFrame, check: Check, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows that break the check: the columns it reads, after the columns to ``keep``."""
    if check.is_aggregate:
        return distinct_count(df, check)
    shown = [quoted(name) for name in dict.fromkeys([*keep, *check.columns()])]
    return df.where(check.broken(df.schema) or "false").selectExpr(*shown)


def distinct_count(df: DataFrame, check: Check) -> DataFrame:
    """One row when ``other``, over rows with a value in ``column``, has not ``expected`` values."""
    other, expected = quoted(check.params["other"]), literal(check.params["expected"])
    counted = df.where(f"{quoted(check.column)} is not null").selectExpr(
        f"count(distinct {other}) as distinct_count"
    )
    return counted.where(f"distinct_count != {expected}")
