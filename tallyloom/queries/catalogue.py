"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import listed, literal
from tallyloom.model import (
    CURRENCY_CODES,
    DATASETS,
    Manifest,
    column_list,
    currency_frame,
    declared_type,
    manifest,
)
from tallyloom.operators import mapping as m
from tallyloom.operators.canonical import (
    Branch,
    MappedFeed,
    canonical_all,
    canonical_one,
    dedup_latest,
    duplicates,
)
from tallyloom.operators.checks import Check, violations
from tallyloom.operators.drift import payload_key_drift, schema_failures
from tallyloom.operators.report import (
    FAILED,
    read_quarantine,
    report,
    select_checks,
    with_failures,
    write_quarantine,
)
from tallyloom.operators.staging import castability
from tallyloom.plans import native, nested_ai, prefixed, seats
from tallyloom.plans.suites import cost_and_usage_suite, provider_suite, staging_suite
from tallyloom.queries import feeds
from tallyloom.session import scratch_path
from tallyloom.sources import (
    column_profile,
    dataset_inventory,
    freshness,
    read_csv,
    read_json,
    read_json_lines,
    read_parquet,
    read_partitioned,
    rows_per_file,
    stage_generic,
    write_partitioned,
)
from tallyloom.sources.inventory import column_coverage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _days_as_timestamps(df: DataFrame) -> DataFrame:
    """Dates widened to timestamps, so that results compare across engines."""
    return df.selectExpr(
        *[
            f"cast({name} as timestamp_ntz) as {name}" if kind == "date" else name
            for name, kind in df.dtypes
        ]
    )


# The staged and mapped feeds the queries start from.


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixed.stage_report(feeds.report(spark, sf_dir))


def _usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_ai.stage_usage(feeds.usage_pages(spark, sf_dir))


def _cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_ai.stage_cost(feeds.cost_pages(spark, sf_dir))


def _seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.stage_seats(feeds.seats(spark, sf_dir))


def _credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.stage_credits(feeds.credits(spark, sf_dir))


def _native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return native.stage_export(feeds.native(spark, sf_dir))


def _ai_feed(spark: SparkSession, sf_dir: str, strict: bool = False) -> MappedFeed:
    """In parity mode by default: a cost row of each type, as ``dedup_report`` then shows."""
    return nested_ai.map_usage_and_cost(_usage(spark, sf_dir), _cost(spark, sf_dir), strict)


def _seat_feed(spark: SparkSession, sf_dir: str) -> MappedFeed:
    return seats.map_seats_and_credits(_seats(spark, sf_dir), _credits(spark, sf_dir))


def _native_feed(spark: SparkSession, sf_dir: str) -> MappedFeed:
    return native.map_export(_native(spark, sf_dir))


def _report_feed(spark: SparkSession, sf_dir: str) -> MappedFeed:
    return prefixed.map_report(_report(spark, sf_dir))


def _all_feeds(spark: SparkSession, sf_dir: str) -> list[MappedFeed]:
    return [
        make(spark, sf_dir) for make in (_ai_feed, _seat_feed, _native_feed, _report_feed)
    ]


# Sources and sinks.


@query("read_csv_all_string")
def read_csv_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    remark = "if(o_orderstatus <> 'P', o_orderpriority || ', \"' || o_orderstatus || '\"', null)"
    path = scratch_path(spark, "orders-csv")
    text = [f"cast({name} as string) as {name}" for name in orders.columns]
    orders.selectExpr(*text, f"{remark} as remark").write.options(header=True, escape='"').csv(path)
    return read_csv(spark, path)


@query("read_parquet_merge")
def read_parquet_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feeds.table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-parquet")
    older = F.coalesce(F.col("event_type").isin("click", "error"), F.lit(False))
    for part in (events.where(older).drop("props"), events.where(~older).drop("value")):
        part.write.partitionBy("event_type").mode("append").parquet(path)
    merged = read_parquet(spark, path)
    return merged.select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("read_ndjson_nested")
def read_ndjson_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "usage-json")
    feeds.usage_pages(spark, sf_dir).drop("_loaded_at").write.json(path)
    # one more file of another form: an array over several lines, of pages without results
    spark.range(1).selectExpr(
        "'[\\n{\"has_more\": false,\\n\"data\": []}\\n]' as value"
    ).write.mode("append").text(path)
    pages = read_json(spark, path, nested_ai.USAGE_PAGE)
    return nested_ai.stage_usage(pages).drop("_loaded_at")


@query("file_inventory")
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = [rows_per_file(feeds.table(spark, sf_dir, name)) for name in feeds.TABLES]
    return reduce(DataFrame.unionByName, counted).select("file_name", "rows")


@query("dataset_inventory")
def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in feeds.TABLES}
    return dataset_inventory(tables)


@query("column_profile")
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_profile(spark.read.parquet(f"{sf_dir}/orders.parquet"))


@query("stage_generic_feed")
def stage_generic_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, typed = feeds.invoices(spark, sf_dir)
    return stage_generic(text, typed, loaded_at="timestamp_ntz'2024-06-01 00:00:00'")


@query("source_freshness")
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness(_usage(spark, sf_dir), "timestamp_ntz'2024-01-31 12:00:00'")


@query("currency_seed_antijoin")
def currency_seed_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Currencies that the seed doesn't have; a missing one is no unknown one."""
    staged = _report(spark, sf_dir).select("CurrencyCode").where("CurrencyCode is not null")
    codes = currency_frame(spark)
    unknown = staged.join(codes, F.col("CurrencyCode") == F.col("currency_code"), "left_anti")
    return unknown.groupBy("CurrencyCode").agg(F.count("*").alias("rows"))


def _written(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "cost-and-usage")
    both = canonical_one(_native_feed(spark, sf_dir)).unionByName(
        canonical_one(_report_feed(spark, sf_dir))
    )
    write_partitioned(both, path)
    return path


@query("write_read_partitioned")
def write_read_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_partitioned(spark, _written(spark, sf_dir))


@query("provider_filter")
def provider_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_partitioned(spark, _written(spark, sf_dir), providers=[native.PROVIDER])


# Staging.


@query("stage_nested_usage")
def stage_nested_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usage(spark, sf_dir)


@query("stage_nested_cost")
def stage_nested_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cost(spark, sf_dir)


@query("stage_usage_csv")
def stage_usage_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days_as_timestamps(seats.stage_credits(feeds.credits(spark, sf_dir, as_text=True)))


@query("stage_seats_csv")
def stage_seats_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days_as_timestamps(seats.stage_seats(feeds.seats(spark, sf_dir, as_text=True)))


@query("stage_native_feed")
def stage_native_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days_as_timestamps(native.stage_export(feeds.native(spark, sf_dir, as_text=True)))


@query("stage_prefixed_feed")
def stage_prefixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixed.stage_report(feeds.report(spark, sf_dir, as_text=True))


# Mapping rules.


def _mapped(rules: dict[str, object]) -> Query:
    return lambda spark, sf_dir: m.rename_map(
        _report(spark, sf_dir), {"Account": "UsageAccountId", "Start": "UsageStartDate"} | rules
    )


QUERIES["map_rule_rename"] = _mapped({"Cost": m.Rename("NetUnblendedCost")})
QUERIES["map_rule_cast"] = _mapped({"Amount": m.Cast("UsageAmount", "bigint")})
QUERIES["map_rule_coalesce"] = _mapped({"Cost": m.Coalesce("NetUnblendedCost", 0.0)})
QUERIES["map_rule_expression"] = _mapped({"Total": m.Expression("UnblendedCost + UsageAmount")})
QUERIES["map_rule_constant"] = _mapped(
    {"Text": m.Constant("it's fixed"), "Number": m.Constant("1.5", "double")}
)
QUERIES["map_rule_concat"] = _mapped(
    {"Label": m.Concat(("CurrencyCode", "'/'", "ResourceId", "'/'", "Region"))}
)
QUERIES["rename_map"] = _mapped(
    {
        "Cost": "UnblendedCost",
        "NetCost": m.Coalesce("NetUnblendedCost", m.Rename("UnblendedCost")),
        "Amount": m.Cast("UsageAmount", "bigint"),
        "Unit": m.Constant("Hours"),
        "Label": m.Concat(("ProductCode", "':'", "Operation")),
        "UnitPrice": m.Expression("UnblendedCost / nullif(UsageAmount, 0)"),
    }
)


@query("apply_mapping")
def apply_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "BilledCost": m.Coalesce("NetUnblendedCost", 0.0),
        "ListCost": "UnblendedCost",
        "ConsumedQuantity": m.Cast("UsageAmount", "bigint"),
        "BillingAccountId": "UsageAccountId",
        "ChargeDescription": m.Concat(("ProductCode", "':'", "CurrencyCode")),
        "ChargePeriodStart": "UsageStartDate",
        "PricingUnit": m.Constant("Hours"),
        "ContractedUnitPrice": m.Expression("UnblendedCost / nullif(UsageAmount, 0)"),
    }
    return m.apply_mapping(_report(spark, sf_dir), rules, "CostAndUsage")


@query("column_list")
def column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset's columns in order, and how many rows the report fills in each."""
    return column_coverage(_report_feed(spark, sf_dir).columns(column_list("CostAndUsage")).drop("_loaded_at"))


@query("type_map")
def type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared type of each column, tried on the report's values as text, some of them unusable."""
    kinds = DATASETS["CostAndUsage"]
    spoiled = ("BilledCost", "ChargePeriodStart", "ChargeDescription")
    text = _report_feed(spark, sf_dir).frame().selectExpr(
        *[
            f"if(BillingCurrency = 'usd', 'about ' || {name}, cast({name} as string)) as {name}"
            if name in spoiled
            else f"cast({name} as string) as {name}"
            for name in kinds
        ]
    )
    spec = {name: (name, kind.replace("json", "string")) for name, kind in kinds.items()}
    declared = listed(x for name in kinds for x in (name, declared_type(name).simpleString()))
    return castability(text, spec).selectExpr(
        "column_name", f"map({declared})[column_name] as declared_type", "present", "not_castable"
    )


@query("select_canonical")
def select_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.select_canonical(_native_feed(spark, sf_dir).frame(), "CostAndUsage")


# Provider mappings.


@query("map_ai_usage")
def map_ai_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ai_feed(spark, sf_dir).frame()


@query("map_ai_usage_strict")
def map_ai_usage_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ai_feed(spark, sf_dir, strict=True).frame()


@query("usage_agg")
def usage_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = nested_ai.usage_totals_with_lists(_usage(spark, sf_dir)).drop("_loaded_at")
    return totals.withColumns(
        {name: F.array_join(name, ",") for name in ("service_tiers", "api_key_ids")}
    )


@query("usage_group_members")
def usage_group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_ai.usage_group_members(_usage(spark, sf_dir))


@query("cost_agg")
def cost_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_ai.cost_totals(_cost(spark, sf_dir))


def _meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_ai.unpivot_meters(nested_ai.usage_totals(_usage(spark, sf_dir)))


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_ai.priced_meters(_usage(spark, sf_dir), _cost(spark, sf_dir), strict=False)


@query("unpivot_meters")
def unpivot_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meters(spark, sf_dir).drop("_loaded_at")


@query("nullsafe_or_join")
def nullsafe_or_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _priced(spark, sf_dir).drop("_loaded_at", "unit", "label", "cost_key")


def _some_rules(rules: dict[str, object], *names: str) -> dict[str, object]:
    return {name: rules[name] for name in names}


_METER_ID = {name: name for name in (*nested_ai.GROUP, "token_slot")}


@query("unit_price_tokens")
def unit_price_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _some_rules(nested_ai.RULES, "BilledCost", "ConsumedQuantity", "ContractedUnitPrice")
    return m.rename_map(_priced(spark, sf_dir), _METER_ID | wanted)


@query("charge_category_slot")
def charge_category_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _some_rules(nested_ai.RULES, "ChargeCategory", "ChargeDescription")
    return m.rename_map(_meters(spark, sf_dir), _METER_ID | wanted)


@query("map_seats_and_credits")
def map_seats_and_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seat_feed(spark, sf_dir).frame()


@query("seat_periods")
def seat_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = seats.seat_periods(_seats(spark, sf_dir))
    return _days_as_timestamps(
        periods.select("user_name", "seat_created_at", "billing_end", "charge_end")
    )


@query("credit_unit_price")
def credit_unit_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _some_rules(seats.CREDIT_RULES, "ContractedUnitPrice", "ListUnitPrice")
    known = {name: name for name in ("user_name", "quantity", "net_amount", "gross_amount")}
    return m.rename_map(_credits(spark, sf_dir), known | wanted)


@query("map_native")
def map_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _native_feed(spark, sf_dir).frame()


@query("map_prefixed")
def map_prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report_feed(spark, sf_dir).frame()


def _report_columns(*names: str) -> Query:
    known = {name: name for name in ("UsageAccountId", "UsageStartDate", "LineItemType")}
    return lambda spark, sf_dir: m.rename_map(
        _report(spark, sf_dir), known | _some_rules(prefixed.RULES, *names)
    )


QUERIES["net_or_list_cost"] = _report_columns(
    "BilledCost", "ContractedCost", "EffectiveCost", "ListCost"
)
QUERIES["line_item_category"] = _report_columns("ChargeCategory")
QUERIES["guarded_unit_price"] = _report_columns("ContractedUnitPrice", "ListUnitPrice")


# Canonical datasets.


@query("canonical_one_provider")
def canonical_one_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_one(_report_feed(spark, sf_dir))


@query("canonical_union")
def canonical_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_all(_all_feeds(spark, sf_dir))


@query("dedup_latest")
def newest_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(canonical_one(_report_feed(spark, sf_dir)))


@query("dedup_report")
def dropped_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(_all_feeds(spark, sf_dir))


@query("billing_period")
def billing_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.conform(stage_generic(feeds.periods(spark, sf_dir)), "BillingPeriod")


@query("invoice_detail")
def invoice_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.conform(stage_generic_feed(spark, sf_dir), "InvoiceDetail")


@query("generic_cost_and_usage")
def generic_cost_and_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that has canonical columns already, staged as a generic one."""
    return m.conform(stage_generic(feeds.native(spark, sf_dir, as_text=True)), "CostAndUsage")


@query("contract_commitment")
def contract_commitment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.conform(stage_generic(feeds.commitments(spark, sf_dir)), "ContractCommitment")


# Checks: each query gives the rows that break the check.


def _breaks(kind: str, column: str, **params: object) -> Query:
    check = Check(kind, column, params=params)
    return lambda spark, sf_dir: violations(feeds.observed(spark, sf_dir), check, ("event_id",))


QUERIES["v_type_string"] = _breaks("type_string", "reading")
QUERIES["v_type_decimal"] = _breaks("type_decimal", "tag")
QUERIES["v_type_datetime"] = _breaks("type_datetime", "payload")
QUERIES["v_type_json"] = _breaks("type_json", "reading")
QUERIES["v_format_string"] = _breaks("format_string", "ts")
QUERIES["v_format_numeric"] = _breaks("format_numeric", "amount")
QUERIES["v_format_datetime"] = _breaks("format_datetime", "seen_at")
QUERIES["v_format_datetime_typed"] = _breaks("format_datetime", "ts")
QUERIES["v_format_currency"] = _breaks("format_currency", "user_id")
QUERIES["v_format_unit"] = _breaks("format_unit", "reading")
QUERIES["v_format_key_value"] = _breaks("format_key_value", "tag")
QUERIES["v_format_json"] = _breaks("format_json", "payload")
QUERIES["v_regex_match"] = _breaks("regex_match", "tag", pattern="^(click|signup):[0-9]+")
QUERIES["v_national_currency"] = _breaks("national_currency", "currency", values=CURRENCY_CODES)
QUERIES["v_greater_or_equal"] = _breaks("greater_or_equal", "reading", threshold=50)
QUERIES["v_less_or_equal"] = _breaks("less_or_equal", "reading", threshold=50)
QUERIES["v_decimal_value"] = _breaks("decimal_value", "amount")
QUERIES["v_column_equality"] = _breaks("column_equality", "event_type", other="same_or_other")
QUERIES["v_multiplication_equals"] = _breaks(
    "multiplication_equals", "reading", factor="user_id", result="hundreds", tolerance=100.0
)
QUERIES["v_string_ends_with"] = _breaks("string_ends_with", "tag", value="7")
QUERIES["v_not_null"] = _breaks("not_null", "tag")
QUERIES["v_accepted_values"] = _breaks("accepted_values", "currency", values=("USD", "XXX"))
for _name, _sign in (("gt", ">"), ("lt", "<"), ("ge", ">="), ("le", "<=")):
    QUERIES[f"v_column_comparison_{_name}"] = _breaks(
        "column_comparison", "reading", other="target", comparator=_sign
    )
for _name, _sign in (("eq", "=="), ("ne", "!=")):
    QUERIES[f"v_column_comparison_{_name}"] = _breaks(
        "column_comparison", "event_type", other="same_or_other", comparator=_sign
    )


@query("v_distinct_count")
def v_distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = Check("distinct_count", "tag", params={"other": "user_id", "expected": 5})
    return violations(feeds.observed(spark, sf_dir), check)


@query("v_castable")
def v_castable(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.observed(spark, sf_dir).selectExpr(
        "amount",
        "if(event_type = 'view', 'many', '' || user_id) as count",
        "if(event_type = 'view', 'soon', date_format(ts, 'yyyy-MM-dd')) as day",
        "if(event_type = 'click', 'today', seen_at) as moment",
        "currency",
    )
    spec = {
        "amount": ("amount", "double"),
        "count": ("count", "bigint"),
        "day": ("day", "date"),
        "moment": ("moment", "timestamp"),
        "currency": ("currency", "string"),
    }
    return castability(raw, spec)


@query("v_schema_assert")
def v_schema_assert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole raw report, with two new columns and one of our own, against its raw manifest."""
    raw = feeds.report(spark, sf_dir).withColumns(
        {
            "line_item/NetUnblendedRate": F.expr("`line_item/NetUnblendedCost` / 2"),
            "resourceTags/team": F.lit(None).cast("string"),
        }
    )
    return schema_failures(raw, manifest("aws_cur", raw=True))


@query("v_payload_key_drift")
def v_payload_key_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a JSON column that its manifest does not name."""
    payload = (
        "case event_type when 'view' then replace(props, 'k', 'unit')"
        " when 'error' then '{\"k\": 1, \"code\": 2, \"retry\": true}'"
        " when 'signup' then substring(props, 2) else props end"
    )
    events = feeds.table(spark, sf_dir, "events").selectExpr(f"{payload} as payload")
    return payload_key_drift(events, "payload", Manifest(frozenset(["k"]), frozenset(["retry"])))


@query("v_page_key_drift")
def v_page_key_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown keys in raw usage pages: new fields at every level, and lines that are no JSON."""
    pages = feeds.usage_pages(spark, sf_dir).selectExpr("to_json(struct(has_more, data)) as value")
    new = {
        '"service_tier":"batch"': '"service_tier":"batch","priority":1',
        '{"has_more":false': '{"has_more":false,"request_id":7',
        '"cache_creation":{"ephemeral_5m_input_tokens":0}': (
            '"cache_creation":{"ephemeral_5m_input_tokens":0,"ephemeral_24h_input_tokens":1}'
        ),
        '"server_tool_use":{"web_search_requests":1}': (
            '"server_tool_use":{"web_search_requests":1,"code_exec":3}'
        ),
    }
    changed = "value"
    for old, more in new.items():
        changed = f"replace({changed}, {literal(old)}, {literal(more)})"
    events = feeds.table(spark, sf_dir, "events")
    broken = events.where("event_type = 'error'").selectExpr("'{\"data\": [' as value")
    path = scratch_path(spark, "pages-text")
    pages.selectExpr(f"{changed} as value").unionByName(broken).write.text(path)
    return nested_ai.raw_key_drift(read_json_lines(spark, path), "usage")


def flawed_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as cost and usage, with tags and JSON of mixed quality."""
    staged = _report(spark, sf_dir)
    rules = prefixed.RULES | {
        "Tags": m.Expression("if(LineItemType = 'Fee', 'fee', 'kind:' || LineItemType)"),
        "ContractApplied": m.Expression(
            "case LineItemType when 'Tax' then '{\"tax\": 1' when 'Usage' then '{\"rate\": 2}' end"
        ),
    }
    return Branch(staged, rules).frame()


@query("v_suite_report")
def v_suite_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(flawed_charges(spark, sf_dir), cost_and_usage_suite())


@query("v_suite_by_tag")
def v_suite_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_checks(cost_and_usage_suite(), tags=["format"], severity="error")
    return report(flawed_charges(spark, sf_dir), chosen)


@query("v_staging_suite")
def v_staging_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = {
        "anthropic_usage": _usage,
        "anthropic_cost": _cost,
        "copilot_usage": _credits,
        "copilot_billing": _seats,
        "azure_ai": _native,
        "aws_cur": _report,
    }
    parts = [
        report(make(spark, sf_dir), staging_suite(name)).selectExpr(f"'{name}' as feed", "*")
        for name, make in staged.items()
    ]
    return reduce(DataFrame.unionByName, parts).drop("tags")


@query("v_provider_suite")
def v_provider_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        report(
            feed.columns(["InvoiceIssuerName", "ServiceProviderName", "BillingCurrency"]),
            provider_suite(feed.provider),
        ).selectExpr(f"'{feed.provider}' as provider", "*")
        for feed in _all_feeds(spark, sf_dir)
    ]
    return reduce(DataFrame.unionByName, parts).drop("tags")


@query("quarantine_split")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on each side of the split, per set of broken checks, after one pass that writes both."""
    path = scratch_path(spark, "quarantine")
    write_quarantine(flawed_charges(spark, sf_dir), cost_and_usage_suite(), path)
    sides = [
        read_quarantine(spark, path, held).selectExpr(
            f"'{name}' as side", f"nullif(array_join({FAILED}, ','), '') as reason"
        )
        for name, held in (("passed", False), ("held", True))
    ]
    return sides[0].unionByName(sides[1]).groupBy("side", "reason").agg(F.count("*").alias("rows"))


@query("quarantine_rows")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the report with the checks it breaks."""
    marked = with_failures(flawed_charges(spark, sf_dir), cost_and_usage_suite())
    return marked.select(
        "SubAccountId",
        "ChargePeriodStart",
        "ChargePeriodEnd",
        "BillingCurrency",
        "BilledCost",
        F.array_join("_failed", ",").alias("failed"),
    )
