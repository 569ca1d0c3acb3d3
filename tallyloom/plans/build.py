"""The whole run: read the feeds, stage, map, unite, check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Literal

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions import literal, utc_instant
from tallyloom.model import STAGED_MANIFESTS, column_list, empty_dataset, manifest
from tallyloom.operators.canonical import PROVIDER, MappedFeed, canonical_all, canonical_one
from tallyloom.operators.checks import Check
from tallyloom.operators.drift import failure_reason, missing_columns, unexpected_columns
from tallyloom.operators.mapping import conform
from tallyloom.operators.report import empty_report, report, select_checks
from tallyloom.operators.staging import LOADED_AT
from tallyloom.plans import native, nested_ai, prefixed, reconcile, seats
from tallyloom.plans.suites import cost_and_usage_suite, provider_suite, staging_suite
from tallyloom.sources.files import read_csv, read_json, read_json_values, with_load_time
from tallyloom.sources.freshness import freshness
from tallyloom.sources.generic import VERSION_COLUMN, read_generic
from tallyloom.sources.sinks import (
    MONTH,
    publish_views,
    read_partitioned,
    with_month,
    write_partitioned,
)

# The providers of a full run, in order, and the feeds each one needs.
PROVIDER_FEEDS = {
    "anthropic": ("anthropic_usage", "anthropic_cost"),
    "copilot": ("copilot_usage", "copilot_billing"),
    "azure_ai": ("azure_ai",),
    "aws_cur": ("aws_cur",),
}

# Generic feeds, their dataset and the name of its staged view.
GENERIC_FEEDS = {
    "cost_and_usage": "CostAndUsage",
    "billing_period": "BillingPeriod",
    "contract_commitment": "ContractCommitment",
    "invoice_detail": "InvoiceDetail",
}


@dataclass(frozen=True)
class Paths:
    """Where the feeds lie, by feed name; generic feeds may have a Parquet side as well."""

    feeds: dict[str, str]
    generic_csv: dict[str, str] = field(default_factory=dict)
    generic_parquet: dict[str, str] = field(default_factory=dict)


# The tags and severity of the assert that a raw feed has only known columns.
ASSERT_TAGS = ("schema", "provider_check")
ASSERT_SEVERITY = "error"

# Fixed value: the column of the placeholder file that stands for a generic feed nobody delivers.
PLACEHOLDER = "dummy_col"


# How the nested feed's costs meet its meters: added up per meter, a row per cost type, or with nothing left over.
Strict = bool | Literal["reconciled"]


@dataclass(frozen=True)
class Build:
    raw: dict[str, DataFrame]
    staged: dict[str, DataFrame]
    mapped: dict[str, DataFrame]
    canonical: dict[str, DataFrame]
    chosen: tuple[str, ...] = ()
    single: bool = False
    strict: Strict = True
    paths: Paths | None = None

    def views(self) -> dict[str, DataFrame]:
        return (
            {f"stg_{name}": df for name, df in self.staged.items()}
            | {f"int_{name}_cost_and_usage": df for name, df in self.mapped.items()}
            | self.canonical
        )

    def publish(self) -> None:
        publish_views(self.views())

    def write(self, path: str, staged_path: str | None = None) -> Build:
        """Writes the staged feeds and cost and usage, and goes on from the written tables.

        Every file is so parsed once: mappings, checks and queries then read Parquet. Staged feeds go to
        folders of ``staged_path``, by default beside the table; that is cut by provider and month.
        """
        base = staged_path or f"{path.rstrip('/')}_staged"
        written = {}
        for name, df in self.staged.items():
            df.write.parquet(f"{base}/{name}")
            written[name] = df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}")
        again = assemble(self.raw, written, self.chosen, self.single, self.strict, self.paths)
        df = again.canonical["CostAndUsage"]
        write_partitioned(with_month(df), path, (PROVIDER, MONTH), rebalance=True)
        table = read_partitioned(df.sparkSession, path, schema=with_month(df).schema)
        return replace(
            again, canonical=again.canonical | {"CostAndUsage": table.select(df.columns)}
        )

    def check(self, tags: Sequence[str] = (), severity: str | None = None) -> DataFrame:
        """The report of all configured checks, one aggregation per frame, with the frame's name."""
        planned: list[tuple[str, DataFrame, list[Check]]] = [
            (f"stg_{name}", df, staging_suite(name)) for name, df in self.staged.items()
        ]
        planned += [
            (f"int_{name}_cost_and_usage", df, provider_suite(name))
            for name, df in self.mapped.items()
        ]
        planned.append(("CostAndUsage", self.canonical["CostAndUsage"], cost_and_usage_suite()))
        parts = []
        for name, df, suite in planned:
            chosen = select_checks(suite, tags=tags, severity=severity)
            if chosen:
                parts.append(report(df, chosen).selectExpr(f"{literal(name)} as dataset", "*"))
        if not parts:
            spark = self.canonical["CostAndUsage"].sparkSession
            return empty_report(spark, "dataset string")
        return reduce(DataFrame.unionByName, parts)

    def asserts_chosen(self, tags: Sequence[str] = (), severity: str | None = None) -> bool:
        """Whether a selection of checks includes the schema asserts."""
        return set(tags) <= set(ASSERT_TAGS) and severity in (None, ASSERT_SEVERITY)

    def schema_failures(self) -> list[tuple[str, str]]:
        """Unexpected columns of the raw and the staged feeds; known from the schemas, no job runs."""
        found = []
        for raw, frames in ((True, self.raw), (False, self.staged)):
            for name, df in frames.items():
                if name in STAGED_MANIFESTS:
                    known = manifest(name, raw=raw)
                    found += [
                        (name, failure_reason(c))
                        for c in unexpected_columns(df, known)
                        if c != "_metadata"
                    ]
                elif not raw and name in GENERIC_FEEDS and not is_placeholder(df):
                    known_columns = {*column_list(GENERIC_FEEDS[name]), LOADED_AT, VERSION_COLUMN}
                    found += [(name, failure_reason(c)) for c in df.columns if c not in known_columns]
        return found

    def missing_columns(self) -> list[tuple[str, str]]:
        """Known columns that a raw CSV feed or a generic feed lacks; they read as NULL."""
        found = []
        for name, df in self.raw.items():
            if name in STAGED_MANIFESTS and name not in PAGES:
                found += [(name, c) for c in missing_columns(df, manifest(name, raw=True)) if c != LOADED_AT]
        for name, df in self.staged.items():
            if name in GENERIC_FEEDS and not is_placeholder(df):
                found += [(name, c) for c in column_list(GENERIC_FEEDS[name]) if c not in df.columns]
        return found

    def key_drift(self) -> DataFrame:
        """Keys of the raw JSON feeds that their pages' shape does not name: feed, level, key, objects."""
        spark = self.canonical["CostAndUsage"].sparkSession
        parts = [
            nested_ai.raw_key_drift(
                read_json_values(spark, self.paths.feeds[name]), name.removeprefix("anthropic_")
            ).selectExpr(f"{literal(name)} as feed", "*")
            for name in self.raw
            if name in PAGES
        ]
        if not parts:
            return spark.createDataFrame([], "feed string, level string, key string, objects bigint")
        return reduce(DataFrame.unionByName, parts)

    def freshness(self, now: str = utc_instant("current_timestamp()"), warn_after_hours: float = 24.0) -> DataFrame:
        """Age of the newest row of each staged feed: feed, loaded_at, age_hours, status."""
        parts = [
            freshness(df, now, warn_after_hours=warn_after_hours).selectExpr(
                f"{literal(name)} as feed", "*"
            )
            for name, df in self.staged.items()
        ]
        return reduce(DataFrame.unionByName, parts)


PAGES = {"anthropic_usage": nested_ai.USAGE_PAGE, "anthropic_cost": nested_ai.COST_PAGE}


def is_placeholder(df: DataFrame) -> bool:
    return {c for c in df.columns if c not in (LOADED_AT, VERSION_COLUMN)} == {PLACEHOLDER}


def read_feeds(spark: SparkSession, paths: Paths, names: Sequence[str]) -> dict[str, DataFrame]:
    return {
        name: read_json(spark, paths.feeds[name], PAGES[name])
        if name in PAGES
        else read_csv(spark, paths.feeds[name])
        for name in names
    }


STAGES = {
    "anthropic_usage": nested_ai.stage_usage,
    "anthropic_cost": nested_ai.stage_cost,
    "copilot_usage": seats.stage_credits,
    "copilot_billing": seats.stage_seats,
    "azure_ai": native.stage_export,
    "aws_cur": prefixed.stage_report,
}


def map_provider(provider: str, staged: dict[str, DataFrame], strict: Strict = True) -> MappedFeed:
    if provider == "anthropic":
        if strict == "reconciled":
            return reconcile.map_reconciled(staged["anthropic_usage"], staged["anthropic_cost"])
        return nested_ai.map_usage_and_cost(
            staged["anthropic_usage"], staged["anthropic_cost"], strict
        )
    if provider == "copilot":
        return seats.map_seats_and_credits(staged["copilot_billing"], staged["copilot_usage"])
    if provider == "azure_ai":
        return native.map_export(staged["azure_ai"])
    if provider == "aws_cur":
        return prefixed.map_report(staged["aws_cur"])
    raise ValueError(f"unknown provider {provider!r}")


def assemble(
    raw: dict[str, DataFrame],
    staged: dict[str, DataFrame],
    chosen: Sequence[str],
    single: bool,
    strict: Strict,
    paths: Paths | None,
) -> Build:
    """The mapped and canonical frames of staged feeds."""
    feeds = [map_provider(name, staged, strict) for name in chosen]
    canonical = {"CostAndUsage": canonical_one(feeds[0]) if single else canonical_all(feeds)}
    spark = canonical["CostAndUsage"].sparkSession
    for name, dataset in GENERIC_FEEDS.items():
        if dataset != "CostAndUsage":
            if name not in staged or is_placeholder(staged[name]):
                canonical[dataset] = empty_dataset(spark, dataset)
            elif not set(staged[name].columns) & set(column_list(dataset)):
                raise ValueError(f"feed {name!r} has no column of {dataset}")
            else:
                canonical[dataset] = conform(staged[name], dataset)
    mapped = {feed.provider: feed.frame() for feed in feeds}
    return Build(raw, staged, mapped, canonical, tuple(chosen), single, strict, paths)


def build(
    spark: SparkSession,
    paths: Paths,
    provider: str | None = None,
    enabled: Sequence[str] = tuple(PROVIDER_FEEDS),
    strict: Strict = True,
) -> Build:
    """All enabled providers with duplicates removed, or one provider with duplicates left in.

    ``strict`` adds up the costs of one meter. Without it, which is the parity mode, two cost types of a meter
    give two rows, and the newest-row selection keeps one of them. ``"reconciled"`` bills a cost that meets no
    meter in a row of its own, so that the billed total is the staged one.
    """
    chosen = [provider] if provider else list(enabled)
    unknown = [name for name in chosen if name not in PROVIDER_FEEDS]
    if unknown or not chosen:
        raise ValueError(f"unknown providers: {', '.join(unknown) or 'none given'}")
    raw = read_feeds(spark, paths, [feed for name in chosen for feed in PROVIDER_FEEDS[name]])
    staged = {name: STAGES[name](with_load_time(df)) for name, df in raw.items()}
    for name in GENERIC_FEEDS:
        if name in paths.generic_csv:
            staged[name] = read_generic(
                spark, paths.generic_csv[name], paths.generic_parquet.get(name)
            )
    return assemble(raw, staged, chosen, provider is not None, strict, paths)
