"""Column rules: how a target column is made from a feed, and the projections built from them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyloom.functions import concat_present, literal, quoted, utc_timestamp
from tallyloom.model import column_list, dataset_schema


@dataclass(frozen=True)
class Rename:
    source: str

    def sql(self) -> str:
        return quoted(self.source)


@dataclass(frozen=True)
class Cast:
    source: str
    kind: str

    def sql(self) -> str:
        return f"cast({quoted(self.source)} as {self.kind})"


@dataclass(frozen=True)
class Coalesce:
    """The source column, or a default: a plain value, or another rule."""

    source: str
    default: object

    def sql(self) -> str:
        default = self.default
        fallback = default.sql() if isinstance(default, Rule) else literal(default)
        return f"coalesce({quoted(self.source)}, {fallback})"


@dataclass(frozen=True)
class Expression:
    text: str

    def sql(self) -> str:
        return self.text


@dataclass(frozen=True)
class Constant:
    value: object
    kind: str = "string"

    def sql(self) -> str:
        return f"cast({literal(self.value)} as {self.kind})"


@dataclass(frozen=True)
class Concat:
    """Text parts, each an expression, joined without a separator; NULL parts are skipped."""

    parts: tuple[str, ...]

    def sql(self) -> str:
        return concat_present(*self.parts)


Rule = Rename | Cast | Coalesce | Expression | Constant | Concat

# target column -> rule; a bare name is a rename
Rules = Mapping[str, Rule | str]


def rule_sql(rule: Rule | str) -> str:
    return quoted(rule) if isinstance(rule, str) else rule.sql()


def _named(sql: str, target: str) -> str:
    return f"{sql} as {quoted(target)}"


def rename_map(df: DataFrame, rules: Rules) -> DataFrame:
    """Only the listed targets, in the listed order."""
    return df.selectExpr(*[_named(rule_sql(rule), target) for target, rule in rules.items()])


def apply_mapping(
    df: DataFrame, rules: Rules, dataset: str, extras: Rules | None = None
) -> DataFrame:
    """Every column of ``dataset`` in order and in its declared type, then ``extras``.

    Columns without a rule are NULL. A rule for a column the dataset does not have is an error.
    """
    schema = dataset_schema(dataset)
    unknown = set(rules) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"{dataset} has no column {sorted(unknown)}")
    columns = [
        _named(typed(rule_sql(rules.get(field.name, Constant(None))), field.dataType), field.name)
        for field in schema
    ]
    columns += [_named(rule_sql(rule), target) for target, rule in (extras or {}).items()]
    return df.selectExpr(*columns)


def typed(sql: str, kind: T.DataType) -> str:
    return f"cast({sql} as {kind.simpleString()})"


def select_canonical(df: DataFrame, dataset: str, keep: Iterable[str] = ()) -> DataFrame:
    """The columns of ``dataset`` in order, as they are."""
    return df.selectExpr(*[quoted(name) for name in [*column_list(dataset), *keep]])


def conform(df: DataFrame, dataset: str, keep: Iterable[str] = ()) -> DataFrame:
    """The columns of ``dataset`` in order and in their declared types; absent ones become NULL."""
    present = dict(df.dtypes)
    columns = []
    for field in dataset_schema(dataset):
        sql = quoted(field.name) if field.name in present else "null"
        if present.get(field.name) == "string" and isinstance(field.dataType, T.TimestampNTZType):
            sql = utc_timestamp(sql)
        columns.append(_named(typed(sql, field.dataType), field.name))
    return df.selectExpr(*columns, *[quoted(name) for name in keep])
