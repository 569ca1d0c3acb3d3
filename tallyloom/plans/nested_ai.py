"""Token usage and its cost, delivered as pages of time buckets that hold lists of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import cast_text, exact_sum, listed, literal
from tallyloom.operators.canonical import Branch, MappedFeed
from tallyloom.operators.drift import UNREADABLE
from tallyloom.operators.mapping import Constant, Expression
from tallyloom.operators.staging import LOADED_AT, load_time
from tallyloom.plans.common import AI_SERVICE, REGULAR, US_DOLLAR, USAGE_BASED, same, vendor

PROVIDER = "anthropic"

# The shape of a usage page.
USAGE_PAGE = """
has_more boolean, next_page string,
data array<struct<
  starting_at string, ending_at string,
  results array<struct<
    uncached_input_tokens bigint, cache_read_input_tokens bigint, output_tokens bigint,
    cache_creation struct<ephemeral_1h_input_tokens bigint, ephemeral_5m_input_tokens bigint>,
    server_tool_use struct<web_search_requests bigint>,
    model string, api_key_id string, workspace_id string, account_id string,
    service_account_id string, service_tier string, context_window string,
    inference_geo string>>>>
"""

# The shape of a cost page.
COST_PAGE = """
has_more boolean, next_page string,
data array<struct<
  starting_at string, ending_at string,
  results array<struct<
    amount string, currency string, cost_type string, description string, model string,
    token_type string, workspace_id string, service_tier string, context_window string,
    inference_geo string>>>>
"""

# Meter, unit, label, the cost feed's name for it (none: matched by cost type).
METERS = (
    ("uncached_input_tokens", "Tokens", "Uncached Input Tokens", "uncached_input_tokens"),
    ("cache_read_input_tokens", "Tokens", "Cache Read Tokens", "cache_read_input_tokens"),
    (
        "cache_creation_1h_tokens",
        "Tokens",
        "Cache Create 1h Tokens",
        "cache_creation.ephemeral_1h_input_tokens",
    ),
    (
        "cache_creation_5m_tokens",
        "Tokens",
        "Cache Create 5m Tokens",
        "cache_creation.ephemeral_5m_input_tokens",
    ),
    ("output_tokens", "Tokens", "Output Tokens", "output_tokens"),
    ("web_search_requests", "Requests", "Web Search Requests", None),
)
FEE_METER = "web_search_requests"
FEE_COST_TYPE = "web_search"

BUCKET = ("bucket_start", "bucket_end")
GROUP = (*BUCKET, "model", "workspace_id")

# Result fields staged under their own name, as text.
_USAGE_TEXT = (
    "model api_key_id workspace_id account_id service_account_id service_tier context_window"
    " inference_geo"
).split()
_COST_TEXT = (
    "currency cost_type description model token_type workspace_id service_tier context_window"
    " inference_geo"
).split()


def _results(pages: DataFrame, loaded_at: str | None) -> DataFrame:
    """One row per result; pages and buckets without results give none.

    The bucket's times are read once per bucket, before its results are opened.
    """
    buckets = pages.selectExpr("explode(data) as b", f"{load_time(pages, loaded_at)} as {LOADED_AT}")
    timed = buckets.selectExpr(
        f"{cast_text('b.starting_at', 'timestamp')} as bucket_start",
        f"{cast_text('b.ending_at', 'timestamp')} as bucket_end",
        "b.results as results",
        LOADED_AT,
    )
    return timed.selectExpr(*BUCKET, "explode(results) as r", LOADED_AT)


def stage_usage(pages: DataFrame, loaded_at: str | None = None) -> DataFrame:
    counts = {
        "uncached_input_tokens": "uncached_input_tokens",
        "cache_read_input_tokens": "cache_read_input_tokens",
        "output_tokens": "output_tokens",
        "cache_creation_1h_tokens": "cache_creation.ephemeral_1h_input_tokens",
        "cache_creation_5m_tokens": "cache_creation.ephemeral_5m_input_tokens",
        "web_search_requests": "server_tool_use.web_search_requests",
    }
    return _results(pages, loaded_at).selectExpr(
        *BUCKET,
        *[f"cast(r.{source} as bigint) as {target}" for target, source in counts.items()],
        *[f"cast(r.{name} as string) as {name}" for name in _USAGE_TEXT],
        LOADED_AT,
    )


def stage_cost(
    pages: DataFrame, loaded_at: str | None = None, units_per_dollar: float = 100.0
) -> DataFrame:
    """Cost results; amounts arrive as text in cents unless ``units_per_dollar`` says otherwise."""
    return _results(pages, loaded_at).selectExpr(
        *BUCKET,
        "cast(r.amount as string) as amount_cents",
        f"cast(r.amount as double) / {literal(float(units_per_dollar))} as amount_usd",
        *[f"cast(r.{name} as string) as {name}" for name in _COST_TEXT],
        LOADED_AT,
    )


_METER_SUMS = [f"sum({meter}) as {meter}" for meter, *_ in METERS]
_NEWEST = f"max({LOADED_AT}) as {LOADED_AT}"


def _aggregate(df: DataFrame, keys: Sequence[str], aggregates: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(aggregate) for aggregate in aggregates])


def usage_totals(usage: DataFrame) -> DataFrame:
    """Meter sums per bucket, model and workspace, and the newest load time."""
    return _aggregate(usage, GROUP, [*_METER_SUMS, _NEWEST])


def usage_totals_with_lists(usage: DataFrame) -> DataFrame:
    """``usage_totals`` plus the distinct service tiers and API keys of each group, sorted.

    Sums are first taken per tier and key. That spreads a hot group over many tasks and leaves the
    list building with one row per distinct pair.
    """
    fine = _aggregate(usage, (*GROUP, "service_tier", "api_key_id"), [*_METER_SUMS, _NEWEST])
    lists = [
        "sort_array(collect_set(service_tier)) as service_tiers",
        "sort_array(collect_set(api_key_id)) as api_key_ids",
    ]
    return _aggregate(fine, GROUP, [*_METER_SUMS, *lists, _NEWEST])


def usage_group_members(usage: DataFrame) -> DataFrame:
    """What the lists hold as rows: each group with one service tier and API key, however many it has."""
    return usage.select(*GROUP, "service_tier", "api_key_id").distinct()


def cost_totals(cost: DataFrame) -> DataFrame:
    """Dollars per bucket, model, workspace, token type and cost type."""
    return _aggregate(
        cost.where("amount_usd is not null"),
        (*GROUP, "token_type", "cost_type"),
        [f"{exact_sum('amount_usd')} as amount_usd"],
    )


def unpivot_meters(totals: DataFrame) -> DataFrame:
    """One row per meter with a positive quantity, in one pass over the totals."""
    kept = [name for name in totals.columns if name not in {meter for meter, *_ in METERS}]
    cells = ", ".join(
        f"{literal(meter)}, {meter}, {listed((unit, label))}, cast({literal(cost_key)} as string)"
        for meter, unit, label, cost_key in METERS
    )
    long = f"stack({len(METERS)}, {cells}) as (token_slot, quantity, unit, label, cost_key)"
    return totals.selectExpr(*kept, long).where("quantity > 0")


def join_cost(meters: DataFrame, costs: DataFrame, strict: bool = True) -> DataFrame:
    """Each meter row with its cost, NULL where there is none.

    Token meters match on the token type, the fee meter on the cost type, so the condition is an OR.
    Spelling out for each cost row the meters it may pay for turns it into a plain equality.

    ``strict`` adds up the costs of a meter first, so that each meter row comes out once with its whole
    cost. Without it, the parity mode, two cost types for one meter give two rows.
    """
    pays_for = f"array('token:' || token_type, if(cost_type = '{FEE_COST_TYPE}', 'fee', null))"
    keyed = costs.selectExpr(
        "bucket_start as c_start",
        "model as c_model",
        "workspace_id as c_workspace",
        f"explode({pays_for}) as c_key",
        "amount_usd",
    ).where("c_key is not null")
    if strict:
        keyed = _aggregate(
            keyed,
            ("c_start", "c_model", "c_workspace", "c_key"),
            [f"{exact_sum('amount_usd')} as amount_usd"],
        )
    wanted = meters.selectExpr("*", "coalesce('token:' || cost_key, 'fee') as m_key")
    same_charge = F.expr(
        "bucket_start = c_start and model = c_model and workspace_id <=> c_workspace"
        " and m_key = c_key"
    )
    joined = wanted.join(keyed, same_charge, "left")
    return joined.drop("m_key", "c_start", "c_model", "c_workspace", "c_key")


BILLED = "coalesce(amount_usd, 0.0D)"

RULES = {
    **same(Expression(BILLED), "BilledCost", "ContractedCost", "EffectiveCost", "ListCost"),
    "ContractedUnitPrice": Expression(
        f"case when unit = 'Tokens' and quantity > 0 then {BILLED} / quantity end"
    ),
    "BillingAccountId": Constant("anthropic_org"),
    "BillingAccountName": Constant("Anthropic Organization"),
    **same(US_DOLLAR, "BillingCurrency", "PricingCurrency"),
    **same("bucket_start", "BillingPeriodStart", "ChargePeriodStart"),
    **same("bucket_end", "BillingPeriodEnd", "ChargePeriodEnd"),
    "ChargeCategory": Expression(f"if(token_slot = '{FEE_METER}', 'Fee', 'Usage')"),
    "ChargeClass": REGULAR,
    "ChargeDescription": Expression("model || ' - ' || label"),
    "ChargeFrequency": USAGE_BASED,
    **same("quantity", "ConsumedQuantity", "PricingQuantity"),
    **same("unit", "ConsumedUnit", "PricingUnit"),
    "ServiceCategory": AI_SERVICE,
    "ServiceName": "model",
    "SubAccountId": "workspace_id",
    "SubAccountType": Constant("Workspace"),
    **vendor("Anthropic"),
}

EXTRAS = {"_token_type": "token_slot", "_token_label": "label"}


def priced_meters(usage: DataFrame, cost: DataFrame, strict: bool = True) -> DataFrame:
    return join_cost(unpivot_meters(usage_totals(usage)), cost_totals(cost), strict)


def map_usage_and_cost(usage: DataFrame, cost: DataFrame, strict: bool = True) -> MappedFeed:
    return MappedFeed(PROVIDER, (Branch(priced_meters(usage, cost, strict), RULES, EXTRAS),))


# The fields of a page, a bucket, a result and the objects in it.
_KNOWN_KEYS = {
    "page": ("data", "has_more", "next_page"),
    "bucket": ("starting_at", "ending_at", "results"),
}
_RESULT_KEYS = {
    "usage": (
        "uncached_input_tokens",
        "cache_read_input_tokens",
        "output_tokens",
        "cache_creation",
        "server_tool_use",
        *_USAGE_TEXT,
    ),
    "cost": ("amount", *_COST_TEXT),
}
_PART_KEYS = {
    "usage": {
        "cache_creation": ("ephemeral_1h_input_tokens", "ephemeral_5m_input_tokens"),
        "server_tool_use": ("web_search_requests",),
    },
    "cost": {},
}


def raw_key_drift(lines: DataFrame, feed: str) -> DataFrame:
    """Keys in raw ``usage`` or ``cost`` pages that no shape above names, and how many objects have them.

    ``lines`` has one JSON page per row in ``value``. Reading with a fixed schema drops unknown
    fields silently, so drift can only be seen here. One pass: pages open into buckets, buckets into
    results, results into the objects they hold, and only unknown keys reach the aggregation. What
    should be an object and isn't counts under the key ``(unreadable)``.
    """
    opened = lines.selectExpr(
        _with_parts("'page'", "value", "'bucket'", "from_json(value, 'data array<string>').data")
    )
    results = "from_json(json, 'results array<string>').results"
    objects = opened.selectExpr(
        _with_parts("level", "json", "'result'", f"if(level = 'bucket', {results}, null)")
    )
    parts = _PART_KEYS[feed]
    if parts:
        shape = listed([", ".join(f"{name} string" for name in parts)])
        inside = ", ".join(f"struct('{n}' as level, from_json(json, {shape}).{n} as json)" for n in parts)
        held = f"if(level = 'result', filter(array({inside}), part -> part.json is not null), null)"
        none = "cast(array() as array<struct<level: string, json: string>>)"
        itself = "array(struct(level as level, json as json))"
        objects = objects.selectExpr(f"inline(concat({itself}, coalesce({held}, {none})))")
    known = _KNOWN_KEYS | {"result": _RESULT_KEYS[feed]} | parts
    unknown = " or ".join(
        f"(level = '{level}' and key not in ({listed(keys)}))" for level, keys in known.items()
    )
    keys = f"coalesce(json_object_keys(json), array({literal(UNREADABLE)}))"
    return (
        objects.selectExpr("level", f"explode({keys}) as key")
        .where(unknown)
        .groupBy("level", "key")
        .agg(F.count("*").alias("objects"))
    )


def _with_parts(level: str, json: str, part_level: str, parts: str) -> str:
    """The object itself and the objects in it, each with its level."""
    itself = f"array(struct({level} as level, {json} as json))"
    inside = f"transform({parts}, part -> struct({part_level} as level, part as json))"
    none = "cast(array() as array<struct<level: string, json: string>>)"
    return f"inline(concat({itself}, coalesce({inside}, {none})))"
