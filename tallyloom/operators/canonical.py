"""Mapped feeds brought together: one provider, all providers, and the newest version of each charge."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import exact_sum, literal, quoted
from tallyloom.model import column_list, dataset_schema
from tallyloom.operators.mapping import Constant, Rules, apply_mapping, rule_sql, typed
from tallyloom.operators.staging import LOADED_AT

DATASET = "CostAndUsage"
PROVIDER = "_provider"

# The columns that identify a charge within a provider.
CHARGE_KEY = ("ChargePeriodStart", "ServiceName", "SubAccountId", "ChargeDescription")


@dataclass(frozen=True)
class Branch:
    """One staged frame and the rules that turn its rows into cost-and-usage rows."""

    staged: DataFrame
    rules: Rules
    extras: Rules = field(default_factory=dict)

    def frame(self, extras: Iterable[str] = ()) -> DataFrame:
        """Canonical columns, load time, then the named extras (NULL where this branch has none)."""
        own = dict.fromkeys(extras, Constant(None)) | dict(self.extras)
        return apply_mapping(self.staged, self.rules, DATASET, {LOADED_AT: LOADED_AT, **own})


@dataclass(frozen=True)
class Narrow:
    """A feed's columns that differ, with the load time; its key among them; all canonical columns from them."""

    frame: DataFrame
    columns: tuple[str, ...]
    key: tuple[str, ...]
    restored: tuple[str, ...]


@dataclass(frozen=True)
class MappedFeed:
    """A provider's mapping to cost and usage, from one or more staged frames."""

    provider: str
    branches: tuple[Branch, ...]

    def frame(self) -> DataFrame:
        """The provider's rows with its extra columns; nothing is removed."""
        extras = list(dict.fromkeys(name for branch in self.branches for name in branch.extras))
        return reduce(DataFrame.unionByName, [branch.frame(extras) for branch in self.branches])

    def columns(self, names: Iterable[str]) -> DataFrame:
        """Some canonical columns and the load time; the others are not even planned."""
        schema = dataset_schema(DATASET)
        return reduce(
            DataFrame.unionByName,
            [
                branch.staged.selectExpr(
                    *[
                        f"{typed(rule_sql(branch.rules.get(name, Constant(None))), schema[name].dataType)}"
                        f" as {name}"
                        for name in names
                    ],
                    LOADED_AT,
                )
                for branch in self.branches
            ],
        )

    def narrow(self, key: Sequence[str] = CHARGE_KEY) -> Narrow:
        """The feed without the columns that are constants or repeat another one.

        A key column that the dataset doesn't have is an error.
        """
        known_columns(key)
        constants: dict[str, str] = {}
        carried: dict[str, str] = {}
        first_with: dict[tuple, str] = {}
        for target in dataset_schema(DATASET):
            rules = tuple(branch.rules.get(target.name, Constant(None)) for branch in self.branches)
            kind = target.dataType.simpleString()
            if isinstance(rules[0], Constant) and all(rule == rules[0] for rule in rules):
                constants[target.name] = typed(rule_sql(rules[0]), target.dataType)
            else:
                carried[target.name] = first_with.setdefault((kind, *rules), target.name)
        distinct = list(dict.fromkeys(carried.values()))
        return Narrow(
            self.columns(distinct),
            tuple(distinct),
            tuple(dict.fromkeys(carried[name] for name in key if name in carried)),
            tuple(f"{constants.get(name) or carried[name]} as {name}" for name in column_list(DATASET)),
        )

    def latest(self, key: Sequence[str] = CHARGE_KEY) -> DataFrame:
        """The newest row of each charge.

        Most canonical columns are constants or repeat another column. Only the ones that differ go
        through the shuffle; the others are put back afterwards. A key column that the dataset doesn't
        have is an error.
        """
        narrow = self.narrow(key)
        newest = dedup_latest(narrow.frame, key=narrow.key, tie_break=narrow.columns)
        return newest.selectExpr(*narrow.restored, LOADED_AT)


def known_columns(names: Iterable[str]) -> None:
    unknown = [name for name in names if name not in dataset_schema(DATASET).names]
    if unknown:
        raise ValueError(f"not columns of {DATASET}: {', '.join(unknown)}")


def dedup_latest(
    df: DataFrame,
    key: Sequence[str] = (PROVIDER, *CHARGE_KEY),
    order: str = LOADED_AT,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, the one with the highest ``order``.

    All columns go through the shuffle; for a mapped feed ``MappedFeed.latest`` carries only those that
    differ.

    Rows that tie are ranked by ``tie_break`` (default: every other column), so a re-run keeps the
    same row. Spark keeps one row per key on the map side too, so a hot key is cut before the shuffle.
    The hash in front of the key lets the sorts compare eight bytes before they compare text.
    """
    missing = [name for name in (*key, order) if name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    ties = df.columns if tie_break is None else tie_break
    ranking = [f"{quoted(order)} desc nulls last"] + [
        f"{quoted(name)} asc nulls last" for name in ties if name not in key and name != order
    ]
    columns = ", ".join(quoted(name) for name in key)
    partition = f"xxhash64({columns}), {columns}" if key else "1"
    rank = f"row_number() over (partition by {partition} order by {', '.join(ranking)}) as _rank"
    return df.selectExpr("*", rank).where("_rank = 1").drop("_rank")


def dedup_report(
    df: DataFrame, key: Sequence[str] = (PROVIDER, *CHARGE_KEY), by: str = PROVIDER
) -> DataFrame:
    """Rows per provider before and after keeping one row per key, and how many go away."""
    per_key = df.groupBy(*dict.fromkeys([by, *key])).count()
    totals = per_key.groupBy(by).agg({"count": "sum", "*": "count"})
    return totals.selectExpr(
        by,
        "`sum(count)` as rows",
        "`count(1)` as kept",
        "`sum(count)` - `count(1)` as dropped",
    )


def canonical_one(feed: MappedFeed) -> DataFrame:
    """One provider's cost and usage, with duplicates left in."""
    return _tagged(feed.frame(), feed.provider)


def canonical_all(
    feeds: Iterable[MappedFeed],
    enabled: Sequence[str] | None = None,
    key: Sequence[str] = CHARGE_KEY,
) -> DataFrame:
    """Cost and usage of all enabled providers, newest row of each charge.

    A charge belongs to one provider, so each feed is reduced on its own before the union.
    """
    feeds = list(feeds)
    unknown = set(enabled or ()) - {feed.provider for feed in feeds}
    if unknown:
        raise ValueError(f"unknown providers: {', '.join(sorted(unknown))}")
    chosen = [feed for feed in feeds if enabled is None or feed.provider in enabled]
    if not chosen:
        raise ValueError("no provider is enabled")
    return reduce(
        DataFrame.unionByName, [_tagged(feed.latest(key), feed.provider) for feed in chosen]
    )


def duplicates(feeds: Iterable[MappedFeed], key: Sequence[str] = CHARGE_KEY) -> DataFrame:
    """What ``canonical_all`` removes, per provider: rows and billed cost, before and after.

    Only the key and the cost are mapped. Of a charge's newest rows ``latest`` keeps the one that is
    first by all columns; the cost leads them, so that row has the smallest cost.
    """
    known_columns(key)
    cost = column_list(DATASET)[0]
    counted = []
    for feed in feeds:
        # Two steps instead of the largest (time, cost) pair, which a hash aggregation can't hold.
        per_load = (
            feed.columns(list(dict.fromkeys([*key, cost])))
            .groupBy(*key, LOADED_AT)
            .agg(
                F.expr("count(*) as n"),
                F.expr(f"{exact_sum(cost)} as cost"),
                F.expr(f"min({cost}) as least"),
            )
        )
        loaded = f"coalesce({LOADED_AT}, timestamp_ntz'0001-01-01 00:00:00')"
        per_charge = per_load.groupBy(*key).agg(
            F.expr("sum(n) as n"),
            F.expr(f"{exact_sum('cost')} as cost"),
            F.expr(f"max_by(least, {loaded}) as kept"),
        )
        counted.append(
            per_charge.selectExpr(
                f"{literal(feed.provider)} as {PROVIDER}",
                "coalesce(sum(n), 0) as rows",
                "count(*) as kept",
                "coalesce(sum(n), 0) - count(*) as dropped",
                f"coalesce({exact_sum('cost')}, 0.0D) as billed",
                f"coalesce({exact_sum('kept')}, 0.0D) as billed_kept",
            )
        )
    return reduce(DataFrame.unionByName, counted)


def _tagged(df: DataFrame, provider: str) -> DataFrame:
    return df.selectExpr(*column_list(DATASET), LOADED_AT, f"{literal(provider)} as {PROVIDER}")
