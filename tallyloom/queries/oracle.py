"""The same results as plain SQL for another engine, written from the feed derivations upwards.

Feeds are stated flat here, without the nesting, text and column rules of the Spark side. Columns
without a value come from the dataset's column list; all else is spelled out.
"""

from __future__ import annotations

from tallyloom.model import (
    COST_AND_USAGE_TABLE,
    CURRENCY_CODES,
    DATASETS,
)
from tallyloom.operators.drift import failure_reason
from tallyloom.queries.feeds import TABLES

_TYPES = {"string": "VARCHAR", "json": "VARCHAR", "double": "DOUBLE", "timestamp": "TIMESTAMP"}


def canonical(source: str, given: dict[str, str], dataset: str = "CostAndUsage", more: str = "") -> str:
    columns = [
        f"CAST({given.get(name, 'NULL')} AS {_TYPES[kind]}) AS {name}"
        for name, kind in DATASETS[dataset].items()
    ]
    assert set(given) <= set(DATASETS[dataset])
    return f"SELECT {', '.join(columns)}{more} FROM ({source})"


def each(value: str, *names: str) -> dict[str, str]:
    return dict.fromkeys(names, value)


def texts(**values: str) -> dict[str, str]:
    return {name: f"'{value}'" for name, value in values.items()}


# Feeds, as staged.

REPORT = """
SELECT date_trunc('month', l_shipdate) AS BillingPeriodStartDate,
  CAST(last_day(l_shipdate) AS TIMESTAMP) AS BillingPeriodEndDate,
  'acct-' || l_suppkey AS UsageAccountId,
  CASE WHEN l_returnflag = 'N' THEN 'DiscountedUsage'
       WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Usage'
       WHEN l_returnflag = 'A' THEN 'Tax'
       WHEN l_linestatus = 'O' THEN 'Fee' ELSE 'Credit' END AS LineItemType,
  l_shipdate AS UsageStartDate,
  l_shipdate + CASE WHEN l_linenumber = 4 THEN INTERVAL 86399500 MILLISECOND
                    ELSE INTERVAL 86399 SECOND END AS UsageEndDate,
  'service-' || l_returnflag AS ProductCode,
  l_linestatus || '-' || l_linenumber AS UsageType,
  'part-' || l_partkey AS Operation,
  CASE WHEN l_linenumber = 7 THEN 0.0 ELSE l_quantity END::DOUBLE AS UsageAmount,
  CASE WHEN l_tax = 0.08::DOUBLE THEN 0.0 ELSE l_extendedprice END::DOUBLE AS UnblendedCost,
  CASE WHEN l_discount > 0 THEN l_extendedprice * (1::DOUBLE - l_discount) END AS NetUnblendedCost,
  CASE WHEN l_linenumber = 1 THEN 'EUR' WHEN l_linenumber = 2 THEN 'usd'
       WHEN l_linenumber <> 3 THEN 'USD' END AS CurrencyCode,
  'Lines of status ' || l_linestatus AS LineItemDescription,
  CASE WHEN l_linenumber > 2 THEN 'order-' || l_orderkey END AS ResourceId,
  'Service ' || l_returnflag AS ProductName,
  'region-' || l_linenumber AS Region,
  CAST(NULL AS VARCHAR) AS InstanceType,
  'Units' AS PricingUnit,
  CASE WHEN l_discount > 0 THEN 'Reserved' ELSE 'OnDemand' END AS PricingTerm,
  l_shipdate + to_days(l_linenumber) AS _loaded_at
FROM lineitem
"""

_BUCKET = """
  date_trunc('hour', ts) AS bucket_start,
  date_trunc('hour', ts) + to_hours(CASE WHEN event_id % 11 = 0 THEN 2 ELSE 1 END) AS bucket_end
"""
_PLACE = "CASE WHEN event_id % 2 = 0 THEN 'us' ELSE 'eu' END AS inference_geo"
_SPACE = "CASE WHEN user_id % 10 > 0 THEN 'ws-' || (user_id % 10) END AS workspace_id"


def _usage_results(tier: str, counts: str, where: str) -> str:
    return f"""
    SELECT {_BUCKET}, {counts}, event_type AS model, 'key-' || (user_id % 5) AS api_key_id, {_SPACE},
      'acct-1' AS account_id, CAST(NULL AS VARCHAR) AS service_account_id,
      '{tier}' AS service_tier, '200000' AS context_window, {_PLACE}, ts AS _loaded_at
    FROM events WHERE {where}"""


USAGE = (
    _usage_results(
        "standard",
        """floor(value * 100)::BIGINT AS uncached_input_tokens,
        (event_id % 4)::BIGINT AS cache_read_input_tokens, user_id::BIGINT AS output_tokens,
        CASE WHEN event_type = 'purchase' THEN floor(value) ELSE 0 END::BIGINT
          AS cache_creation_1h_tokens,
        CASE WHEN event_type <> 'view' THEN event_id % 3 END::BIGINT AS cache_creation_5m_tokens,
        CASE WHEN event_type = 'click' THEN 1 ELSE 0 END::BIGINT AS web_search_requests""",
        "event_type <> 'error'",
    )
    + " UNION ALL "
    + _usage_results(
        "batch",
        """1::BIGINT, 0::BIGINT, (event_id % 7)::BIGINT, NULL::BIGINT, 0::BIGINT, 2::BIGINT""",
        "event_type = 'signup'",
    )
)

COST = f"""
SELECT {_BUCKET}, cents::VARCHAR AS amount_cents, cents::DOUBLE / 100.0::DOUBLE AS amount_usd,
  'USD' AS currency,
  CASE WHEN event_id % 6 = 5 THEN 'web_search' WHEN event_id % 13 = 0 THEN 'manual'
       ELSE 'tokens' END AS cost_type,
  'Usage costs' AS description, event_type AS model,
  ['uncached_input_tokens', 'cache_read_input_tokens', 'cache_creation.ephemeral_1h_input_tokens',
   'cache_creation.ephemeral_5m_input_tokens', 'output_tokens'][event_id % 6 + 1] AS token_type,
  {_SPACE}, 'standard' AS service_tier, '200000' AS context_window, {_PLACE}, ts AS _loaded_at
FROM (SELECT *, CASE WHEN event_type <> 'view' THEN floor(value * 100)::BIGINT END AS cents
      FROM events)
"""

SEATS = """
SELECT c_name AS user_name, 'org' AS organization, c_mktsegment AS team,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'enterprise' ELSE 'business' END
    AS plan_type,
  date_trunc('day', first)::TIMESTAMP AS seat_created_at,
  first + to_days(orders::INTEGER) AS last_activity_at,
  'editor' AS last_activity_editor,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 39.0 ELSE 19.0 END::DOUBLE
    AS monthly_cost,
  first + to_days(orders::INTEGER) AS _loaded_at
FROM customer LEFT JOIN (
  SELECT o_custkey, min(o_orderdate) AS first, count(*) AS orders FROM orders GROUP BY 1
) ON o_custkey = c_custkey
"""

CREDITS = """
SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS usage_date, 'Assistant' AS product,
  'sku-' || o_orderstatus AS sku, o_orderpriority AS model, 'requests' AS unit_type,
  (o_orderkey % 7)::BIGINT AS quantity, o_totalprice AS gross_amount, d AS discount_amount,
  o_totalprice - d AS net_amount, 'org' AS organization, 'user-' || o_custkey AS user_name,
  o_orderstatus AS team, o_orderdate AS _loaded_at
FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 100.0 ELSE 0.0 END::DOUBLE AS d FROM orders)
"""

NATIVE = """
SELECT p_retailprice AS BilledCost, p_size::DOUBLE AS ConsumedQuantity,
  p_retailprice AS ContractedCost, p_retailprice / p_size AS ContractedUnitPrice,
  p_retailprice AS EffectiveCost, p_retailprice * 2 AS ListCost,
  p_retailprice * 2 / p_size AS ListUnitPrice,
  TIMESTAMP '2024-01-01' AS BillingPeriodStart, TIMESTAMP '2024-01-31' AS BillingPeriodEnd,
  TIMESTAMP '2024-01-01' + to_days(p_size) AS ChargePeriodStart,
  TIMESTAMP '2024-01-02' + to_days(p_size) AS ChargePeriodEnd,
  p_brand AS BillingAccountId, 'Account of ' || p_brand AS BillingAccountName,
  CASE WHEN p_size = 50 THEN 'GBP' ELSE 'USD' END AS BillingCurrency, 'Usage' AS ChargeCategory,
  'Regular' AS ChargeClass, p_name AS ChargeDescription, 'Usage-Based' AS ChargeFrequency,
  '1K Tokens' AS ConsumedUnit, '/resource/' || p_partkey AS ResourceId,
  lower(p_type) AS ResourceType, 'AI and Machine Learning' AS ServiceCategory,
  p_type AS ServiceName, CASE WHEN p_size > 10 THEN 'Text' END AS ServiceSubcategory,
  'sku-' || p_partkey AS SkuId, p_brand AS SubAccountId, p_brand AS SubAccountName,
  'Subscription' AS SubAccountType, 'region-' || (p_size % 4) AS RegionId,
  p_type AS MeterCategory, p_brand AS MeterSubCategory, p_name AS MeterName,
  'group-' || (p_size % 3) AS ResourceGroup, 'region-' || (p_size % 4) AS ResourceLocation,
  TIMESTAMP '2024-02-01' + to_days(p_size) AS _loaded_at
FROM part
"""

OBSERVED = """
SELECT event_id, ts, user_id, event_type, floor(value)::BIGINT AS hundreds,
  CASE WHEN event_type <> 'error' THEN value END AS reading,
  CASE WHEN event_type = 'view' THEN 'view : ' || user_id
       WHEN event_type <> 'error' THEN event_type || ':' || user_id END AS tag,
  CASE WHEN event_type = 'click' THEN replace(props, '}', '')
       WHEN event_type = 'signup' THEN props || 'x'
       WHEN event_type <> 'error' THEN props END AS payload,
  CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
    WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 'signup' THEN year(ts) || '-' || month(ts) || '-' || day(ts)
    WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS seen_at,
  CASE event_type WHEN 'view' THEN 'n/a' WHEN 'signup' THEN '-1.5e3'
    WHEN 'purchase' THEN value::VARCHAR || ' USD' WHEN 'click' THEN value::VARCHAR END AS amount,
  [NULL, 'usd', 'USD', 'XXX', 'EUR', 'ZZZ'][user_id % 6 + 1] AS currency,
  value + [0, 1, -1][event_id % 3 + 1] AS target,
  CASE user_id % 3 WHEN 0 THEN event_type WHEN 2 THEN 'other' END AS same_or_other
FROM events
"""

# The nested feed's aggregates and its cost join.

_METER_SUMS = ", ".join(
    f"SUM({name})::BIGINT AS {name}"
    for name in (
        "uncached_input_tokens",
        "cache_read_input_tokens",
        "cache_creation_1h_tokens",
        "cache_creation_5m_tokens",
        "output_tokens",
        "web_search_requests",
    )
)
_GROUP = "bucket_start, bucket_end, model, workspace_id"
TOTALS = f"SELECT {_GROUP}, {_METER_SUMS}, MAX(_loaded_at) AS _loaded_at FROM ({USAGE}) GROUP BY ALL"
COSTS = f"""
SELECT {_GROUP}, token_type, cost_type, SUM(amount_usd::DECIMAL(18, 4))::DOUBLE AS amount_usd
FROM ({COST}) WHERE amount_usd IS NOT NULL GROUP BY ALL
"""
METERS = f"""
SELECT {_GROUP}, _loaded_at, token_slot, quantity,
  CASE WHEN token_slot = 'web_search_requests' THEN 'Requests' ELSE 'Tokens' END AS unit,
  CASE token_slot WHEN 'uncached_input_tokens' THEN 'Uncached Input Tokens'
    WHEN 'cache_read_input_tokens' THEN 'Cache Read Tokens'
    WHEN 'cache_creation_1h_tokens' THEN 'Cache Create 1h Tokens'
    WHEN 'cache_creation_5m_tokens' THEN 'Cache Create 5m Tokens'
    WHEN 'output_tokens' THEN 'Output Tokens' ELSE 'Web Search Requests' END AS label,
  CASE token_slot WHEN 'cache_creation_1h_tokens' THEN 'cache_creation.ephemeral_1h_input_tokens'
    WHEN 'cache_creation_5m_tokens' THEN 'cache_creation.ephemeral_5m_input_tokens'
    WHEN 'web_search_requests' THEN NULL ELSE token_slot END AS cost_key
FROM (UNPIVOT ({TOTALS}) ON uncached_input_tokens, cache_read_input_tokens,
  cache_creation_1h_tokens, cache_creation_5m_tokens, output_tokens, web_search_requests
  INTO NAME token_slot VALUE quantity)
WHERE quantity > 0
"""


def _priced(costs: str) -> str:
    return f"""
SELECT f.*, c.amount_usd FROM ({METERS}) f LEFT JOIN ({costs}) c
  ON c.bucket_start = f.bucket_start AND c.model = f.model
  AND c.workspace_id IS NOT DISTINCT FROM f.workspace_id
  AND CASE WHEN f.cost_key IS NULL THEN c.cost_type = 'web_search'
           ELSE c.token_type = f.cost_key END
"""


PRICED = _priced(COSTS)

# Costs of one meter added up: by what they pay for, not by cost type.
PRICED_WHOLE = f"""
SELECT f.*, c.amount_usd FROM ({METERS}) f LEFT JOIN (
  SELECT bucket_start, model, workspace_id, token_type AS paid,
    SUM(amount_usd::DECIMAL(18, 4))::DOUBLE AS amount_usd
  FROM ({COSTS}) WHERE token_type IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT bucket_start, model, workspace_id, NULL, SUM(amount_usd::DECIMAL(18, 4))::DOUBLE
  FROM ({COSTS}) WHERE cost_type = 'web_search' GROUP BY ALL
) c ON c.bucket_start = f.bucket_start AND c.model = f.model
  AND c.workspace_id IS NOT DISTINCT FROM f.workspace_id AND c.paid IS NOT DISTINCT FROM f.cost_key
"""

# Mappings.


def _issuer(name: str) -> dict[str, str]:
    return each(f"'{name}'", "InvoiceIssuerName", "HostProviderName", "ServiceProviderName")


_AI = texts(ChargeClass="Regular", ServiceCategory="AI / LLM")
_USD = each("'USD'", "BillingCurrency", "PricingCurrency")
_PAID = "COALESCE(amount_usd, 0.0)"

AI_COLUMNS = {
    **_AI,
    **_USD,
    **_issuer("Anthropic"),
    **texts(
        BillingAccountId="anthropic_org",
        BillingAccountName="Anthropic Organization",
        ChargeFrequency="Usage-Based",
        SubAccountType="Workspace",
    ),
    **each(_PAID, "BilledCost", "ContractedCost", "EffectiveCost", "ListCost"),
    "ContractedUnitPrice": f"CASE unit WHEN 'Tokens' THEN {_PAID} / quantity END",
    **each("bucket_start", "BillingPeriodStart", "ChargePeriodStart"),
    **each("bucket_end", "BillingPeriodEnd", "ChargePeriodEnd"),
    "ChargeCategory": "CASE unit WHEN 'Requests' THEN 'Fee' ELSE 'Usage' END",
    "ChargeDescription": "model || ' - ' || label",
    **each("quantity", "ConsumedQuantity", "PricingQuantity"),
    **each("unit", "ConsumedUnit", "PricingUnit"),
    "ServiceName": "model",
    "SubAccountId": "workspace_id",
}
AI = canonical(
    PRICED, AI_COLUMNS, more=", _loaded_at, token_slot AS _token_type, label AS _token_label"
)
AI_WHOLE = canonical(
    PRICED_WHOLE, AI_COLUMNS, more=", _loaded_at, token_slot AS _token_type, label AS _token_label"
)

_MEMBER = {
    **_AI,
    **_USD,
    **_issuer("GitHub"),
    **texts(
        BillingAccountId="myorg",
        BillingAccountName="My Organization",
        ChargeCategory="Usage",
        ServiceName="GitHub Copilot",
        SubAccountType="User",
    ),
    **each("user_name", "SubAccountId", "SubAccountName"),
}
SEAT_ROWS = canonical(
    SEATS,
    {
        **_MEMBER,
        **each(
            "monthly_cost",
            "BilledCost",
            "ContractedCost",
            "ContractedUnitPrice",
            "EffectiveCost",
            "ListCost",
        ),
        **each("seat_created_at", "BillingPeriodStart", "ChargePeriodStart"),
        "BillingPeriodEnd": "last_day(seat_created_at)",
        "ChargePeriodEnd": "seat_created_at + INTERVAL 1 MONTH - INTERVAL 1 DAY",
        "ChargeDescription": "'GitHub Copilot ' || plan_type || ' - ' || user_name",
        "ChargeFrequency": "'Recurring'",
        **each("1", "ConsumedQuantity", "PricingQuantity"),
        **each("'Seats'", "ConsumedUnit", "PricingUnit"),
        "ServiceSubcategory": "plan_type",
    },
    more=", _loaded_at, 'seat' AS _charge_type, plan_type AS _plan_type, CAST(NULL AS VARCHAR) AS _model",
)
CREDIT_ROWS = canonical(
    CREDITS,
    {
        **_MEMBER,
        **each("net_amount", "BilledCost", "ContractedCost", "EffectiveCost"),
        "ListCost": "gross_amount",
        "ContractedUnitPrice": "CASE WHEN quantity <> 0 THEN net_amount / quantity END",
        "ListUnitPrice": "CASE WHEN quantity <> 0 THEN gross_amount / quantity END",
        **each(
            "usage_date",
            "BillingPeriodStart",
            "BillingPeriodEnd",
            "ChargePeriodStart",
            "ChargePeriodEnd",
        ),
        "ChargeDescription": "'GitHub Copilot AI Credits - ' || model",
        "ChargeFrequency": "'Usage-Based'",
        **each("quantity", "ConsumedQuantity", "PricingQuantity"),
        **each("unit_type", "ConsumedUnit", "PricingUnit"),
        "ServiceSubcategory": "model",
        "SkuId": "sku",
    },
    more=", _loaded_at, 'ai_credits' AS _charge_type, NULL AS _plan_type, model AS _model",
)
SEATS_AND_CREDITS = f"{SEAT_ROWS} UNION ALL {CREDIT_ROWS}"

_NATIVE_OWN = [
    name for name in DATASETS["CostAndUsage"] if f" AS {name}," in NATIVE.replace("\n", " ")
]
NATIVE_ROWS = canonical(
    NATIVE,
    {
        **{name: name for name in _NATIVE_OWN},
        **_issuer("Microsoft"),
        "PricingCurrency": "BillingCurrency",
        "PricingQuantity": "ConsumedQuantity",
        "PricingUnit": "ConsumedUnit",
    },
    more=", _loaded_at, MeterCategory AS _meter_category, MeterName AS _meter_name,"
    " ResourceGroup AS _resource_group",
)

_NET = "COALESCE(NetUnblendedCost, UnblendedCost)"
_CATEGORY = (
    "CASE WHEN LineItemType = 'Credit' THEN 'Adjustment' WHEN LineItemType = 'Fee' THEN 'Fee'"
    " ELSE 'Usage' END"
)


def _price(cost: str) -> str:
    return f"CASE WHEN {cost} <> 0 AND UsageAmount <> 0 THEN {cost} / UsageAmount END"


REPORT_COLUMNS = {
    **_AI,
    **_issuer("AWS"),
    **each(_NET, "BilledCost", "ContractedCost", "EffectiveCost"),
    "ListCost": "UnblendedCost",
    "ContractedUnitPrice": _price(_NET),
    "ListUnitPrice": _price("UnblendedCost"),
    **each("UsageAccountId", "BillingAccountId", "BillingAccountName", "SubAccountId"),
    **texts(SubAccountType="Account", ChargeFrequency="Usage-Based"),
    **each("CurrencyCode", "BillingCurrency", "PricingCurrency"),
    "BillingPeriodStart": "BillingPeriodStartDate",
    "BillingPeriodEnd": "BillingPeriodEndDate",
    "ChargePeriodStart": "UsageStartDate",
    "ChargePeriodEnd": "UsageEndDate",
    "ChargeCategory": _CATEGORY,
    "ChargeDescription": "LineItemDescription",
    **each("UsageAmount", "ConsumedQuantity", "PricingQuantity"),
    **each("'Units'", "ConsumedUnit", "PricingUnit"),
    "ServiceName": "ProductCode",
    "ServiceSubcategory": "UsageType",
    "ResourceId": "ResourceId",
    "RegionId": "Region",
}
REPORT_ROWS = canonical(
    REPORT,
    REPORT_COLUMNS,
    more=", _loaded_at, LineItemType AS _line_item_type, Operation AS _operation,"
    " PricingTerm AS _pricing_term",
)
FLAWED = canonical(
    REPORT,
    {
        **REPORT_COLUMNS,
        "Tags": "CASE LineItemType WHEN 'Fee' THEN 'fee' ELSE 'kind:' || LineItemType END",
        "ContractApplied": """CASE LineItemType WHEN 'Tax' THEN '{"tax": 1'
          WHEN 'Usage' THEN '{"rate": 2}' END""",
    },
    more=", _loaded_at",
)

_NAMES = list(DATASETS["CostAndUsage"])
_KEY = ("ChargePeriodStart", "ServiceName", "SubAccountId", "ChargeDescription")


def tagged(provider: str, rows: str) -> str:
    return f"SELECT {', '.join(_NAMES)}, _loaded_at, '{provider}' AS _provider FROM ({rows})"


ALL_ROWS = " UNION ALL ".join(
    tagged(provider, rows)
    for provider, rows in (
        ("anthropic", AI),
        ("copilot", SEATS_AND_CREDITS),
        ("azure_ai", NATIVE_ROWS),
        ("aws_cur", REPORT_ROWS),
    )
)


def newest(rows: str) -> str:
    """One row per charge: newest first, then by every column."""
    ties = ", ".join(f"{name} ASC NULLS LAST" for name in _NAMES)
    return f"""
    SELECT {', '.join(_NAMES)}, _loaded_at, _provider FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY _provider, {', '.join(_KEY)}
        ORDER BY _loaded_at DESC NULLS LAST, {ties}) AS place FROM ({rows})
    ) WHERE place = 1"""


# Check suites.

# The checks of cost and usage, one a line: column, check, severity, tags.
CHECKS = [
    line.split()
    for line in """
BilledCost type_decimal error focus,type,cost_and_usage
BilledCost format_numeric error focus,format,cost_and_usage
BilledCost not_null error focus,presence,cost_and_usage
BillingAccountId type_string error focus,type,cost_and_usage
BillingAccountId format_string error focus,format,cost_and_usage
BillingAccountId not_null error focus,presence,cost_and_usage
BillingAccountName type_string error focus,type,cost_and_usage
BillingAccountName not_null error focus,presence,cost_and_usage
BillingAccountType type_string warn focus,type,conditional
BillingCurrency type_string error focus,type,cost_and_usage
BillingCurrency format_currency error focus,format,cost_and_usage
BillingCurrency national_currency error focus,currency,cost_and_usage
BillingCurrency not_null error focus,presence,cost_and_usage
BillingPeriodStart type_datetime error focus,type,cost_and_usage
BillingPeriodStart format_datetime error focus,format,cost_and_usage
BillingPeriodStart not_null error focus,presence,cost_and_usage
BillingPeriodEnd type_datetime error focus,type,cost_and_usage
BillingPeriodEnd format_datetime error focus,format,cost_and_usage
BillingPeriodEnd not_null error focus,presence,cost_and_usage
ChargeCategory type_string error focus,type,cost_and_usage
ChargeCategory not_null error focus,presence,cost_and_usage
ChargeClass type_string error focus,type,cost_and_usage
ChargeClass not_null error focus,presence,cost_and_usage
ChargeDescription type_string error focus,type,cost_and_usage
ChargeDescription not_null error focus,presence,cost_and_usage
ChargeFrequency type_string warn focus,type,cost_and_usage
ChargePeriodStart type_datetime error focus,type,cost_and_usage
ChargePeriodStart format_datetime error focus,format,cost_and_usage
ChargePeriodStart not_null error focus,presence,cost_and_usage
ChargePeriodEnd type_datetime error focus,type,cost_and_usage
ChargePeriodEnd format_datetime error focus,format,cost_and_usage
ChargePeriodEnd not_null error focus,presence,cost_and_usage
CommitmentDiscountCategory type_string warn focus,type,conditional
CommitmentDiscountId type_string warn focus,type,conditional
CommitmentDiscountName type_string warn focus,type,conditional
CommitmentDiscountQuantity type_decimal warn focus,type,conditional
CommitmentDiscountStatus type_string warn focus,type,conditional
CommitmentDiscountType type_string warn focus,type,conditional
CommitmentDiscountUnit type_string warn focus,type,conditional
ConsumedQuantity type_decimal warn focus,type,conditional
ConsumedUnit type_string warn focus,type,conditional
ContractedCost type_decimal error focus,type,cost_and_usage
ContractedCost format_numeric error focus,format,cost_and_usage
ContractedCost not_null error focus,presence,cost_and_usage
ContractedUnitPrice type_decimal warn focus,type,conditional
EffectiveCost type_decimal error focus,type,cost_and_usage
EffectiveCost format_numeric error focus,format,cost_and_usage
EffectiveCost not_null error focus,presence,cost_and_usage
ListCost type_decimal error focus,type,cost_and_usage
ListCost format_numeric error focus,format,cost_and_usage
ListCost not_null error focus,presence,cost_and_usage
ListUnitPrice type_decimal warn focus,type,conditional
PricingCategory type_string warn focus,type,conditional
PricingCurrency type_string warn focus,type,conditional
PricingCurrency format_currency warn focus,format,conditional
PricingQuantity type_decimal error focus,type,cost_and_usage
PricingQuantity format_numeric error focus,format,cost_and_usage
PricingQuantity not_null error focus,presence,cost_and_usage
PricingUnit type_string error focus,type,cost_and_usage
PricingUnit format_unit error focus,format,cost_and_usage
PricingUnit not_null error focus,presence,cost_and_usage
ServiceCategory type_string error focus,type,cost_and_usage
ServiceCategory not_null error focus,presence,cost_and_usage
ServiceName type_string error focus,type,cost_and_usage
ServiceName not_null error focus,presence,cost_and_usage
ServiceSubcategory type_string warn focus,type,cost_and_usage
SkuId type_string warn focus,type,conditional
SkuMeter type_string warn focus,type,conditional
SkuPriceDetails type_string warn focus,type,conditional
SkuPriceId type_string warn focus,type,conditional
SubAccountId type_string warn focus,type,conditional
SubAccountName type_string warn focus,type,conditional
SubAccountType type_string warn focus,type,conditional
AvailabilityZone type_string warn focus,type,conditional
CapacityReservationId type_string warn focus,type,conditional
CapacityReservationStatus type_string warn focus,type,conditional
ResourceId type_string warn focus,type,conditional
ResourceName type_string warn focus,type,conditional
ResourceType type_string warn focus,type,conditional
RegionId type_string error focus,type,cost_and_usage
RegionName type_string warn focus,type,conditional
Tags format_key_value warn focus,format,conditional
InvoiceId type_string warn focus,type,conditional
InvoiceIssuerName type_string error focus,type,cost_and_usage
InvoiceIssuerName not_null error focus,presence,cost_and_usage
InvoiceDetailId type_string warn focus,type,conditional
AllocatedResourceId type_string warn focus,type,conditional
AllocatedResourceName type_string warn focus,type,conditional
AllocatedMethodId type_string warn focus,type,conditional
AllocatedMethodDetails type_json warn focus,type,conditional
AllocatedMethodDetails format_json warn focus,format,conditional
AllocatedTags format_key_value warn focus,format,conditional
ContractApplied type_json warn focus,type,conditional
ContractApplied format_json warn focus,format,conditional
CommitmentProgramEligibilityDetails type_json warn focus,type,conditional
CommitmentProgramEligibilityDetails format_json warn focus,format,conditional
HostProviderName type_string error focus,type,cost_and_usage
HostProviderName not_null error focus,presence,cost_and_usage
ServiceProviderName type_string error focus,type,cost_and_usage
ServiceProviderName not_null error focus,presence,cost_and_usage
""".strip().splitlines()
]


def _breaks(check_name: str, column: str) -> str:
    """What a row must look like to break a canonical check; every column has its declared type."""
    if check_name == "not_null":
        return f"{column} IS NULL"
    if check_name == "national_currency":
        return f"{column} NOT IN ({', '.join(repr(code) for code in CURRENCY_CODES)})"
    if check_name == "format_datetime":
        return f"microsecond({column}) % 1000000 <> 0"
    if check_name == "format_key_value":
        return f"NOT regexp_full_match({column}, '[A-Za-z0-9_]+:[A-Za-z0-9_]+')"
    if check_name == "format_json":
        return f"NOT json_valid({column})"
    family = {"type_decimal": "DOUBLE", "format_numeric": "DOUBLE", "type_datetime": "TIMESTAMP"}
    return f"{column} IS NOT NULL AND typeof({column}) <> '{family.get(check_name, 'VARCHAR')}'"


def suite(rows: str, only: str | None = None, severity: str | None = None) -> str:
    found = []
    for column, kind, level, tags in CHECKS:
        if (only is None or only in tags.split(",")) and severity in (None, level):
            found.append(
                f"SELECT '{column}' AS column_name, '{kind}' AS check_name,"
                f" '{level}' AS severity, '{tags}' AS tags,"
                f" count(*) FILTER (WHERE {_breaks(kind, column)}) AS violations FROM r"
            )
    return f"""
    WITH r AS MATERIALIZED ({rows}), counted AS ({' UNION ALL '.join(found)})
    SELECT *, CASE WHEN violations > 0 THEN severity ELSE 'pass' END AS status FROM counted"""


def counted_checks(label: str, parts: list[tuple[str, str, list[tuple[str, str, str]]]]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, '{column}' AS column_name, '{kind}' AS check_name,"
        f" 'error' AS severity, count(*) FILTER (WHERE {broken}) AS violations FROM ({source})"
        for name, source, checks in parts
        for column, kind, broken in checks
    )
    return f"SELECT *, CASE WHEN violations > 0 THEN 'error' ELSE 'pass' END AS status FROM ({rows})"


def _present(*columns: str) -> list[tuple[str, str, str]]:
    return [(column, "not_null", f"{column} IS NULL") for column in columns]


def _issued(name: str) -> list[tuple[str, str, str]]:
    wanted = (("InvoiceIssuerName", name), ("ServiceProviderName", name), ("BillingCurrency", "USD"))
    return [(column, "accepted_values", f"{column} <> '{value}'") for column, value in wanted]


_ROW_CHECKS = [
    (column, kind)
    for column, kind, level, _ in CHECKS
    if level == "error" and kind in ("not_null", "national_currency", "format_datetime")
]
MARKED = (
    "SELECT *, concat_ws(',', "
    + ", ".join(
        f"CASE WHEN {_breaks(kind, column)} THEN '{kind}:{column}' END"
        for column, kind in _ROW_CHECKS
    )
    + f") AS failed FROM ({FLAWED})"
)


def breaks(column: str, condition: str, *others: str) -> str:
    shown = ", ".join(["event_id", column, *others])
    return f"SELECT {shown} FROM ({OBSERVED}) WHERE {condition}"


def of_type(column: str, *types: str) -> str:
    kinds = ", ".join(f"'{kind}'" for kind in types)
    return breaks(column, f"{column} IS NOT NULL AND typeof({column}) NOT IN ({kinds})")


_KNOWN_CURRENCY = ", ".join(f"'{code}'" for code in CURRENCY_CODES)
_MAPPED = "SELECT UsageAccountId AS Account, UsageStartDate AS Start"


def _counts(rows: str, entries: list[str]) -> str:
    return f"WITH r AS MATERIALIZED ({rows}) " + " UNION ALL ".join(entries)


def _type_map() -> str:
    spark_names = {"string": "string", "json": "string", "double": "double", "timestamp": "timestamp_ntz"}
    entries = []
    for name, kind in DATASETS["CostAndUsage"].items():
        spoiled = name in ("BilledCost", "ChargePeriodStart")
        bad = "count(*) FILTER (WHERE BillingCurrency = 'usd')" if spoiled else "0"
        entries.append(
            f"SELECT '{name}' AS column_name, '{spark_names[kind]}' AS declared_type,"
            f" count({name}) AS present, ({bad})::BIGINT AS not_castable FROM r"
        )
    return _counts(REPORT_ROWS, entries)


def _profile() -> str:
    spark_name = (
        "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'"
        " WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END"
    )
    ranges = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS null_rows,"
        f" min({name})::VARCHAR AS min_value, max({name})::VARCHAR AS max_value FROM orders"
        for name in (
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        )
    )
    return f"""
        SELECT column_name, {spark_name} AS data_type, "null" AS is_nullable, null_rows, min_value, max_value
        FROM (DESCRIBE orders) FULL JOIN ({ranges}) USING (column_name)"""


_CONFORM_INVOICE = """
SELECT o_totalprice AS BilledCost, 'acct-' || o_custkey AS BillingAccountId, 'USD' AS BillingCurrency,
  'detail-' || o_orderkey AS InvoiceDetailId, 'invoice-' || o_custkey AS InvoiceId,
  o_orderdate AS InvoiceIssueDate,
  CASE WHEN o_orderstatus IS DISTINCT FROM 'F' THEN 'EUR' END AS PaymentCurrency,
  CASE WHEN o_orderstatus IS DISTINCT FROM 'F' THEN o_totalprice * 0.5 END AS PaymentCurrencyBilledCost
FROM orders
"""

_PERIODS = """
SELECT o_orderdate AS created, CAST(last_day(o_orderdate) AS TIMESTAMP) AS ending,
  date_trunc('month', o_orderdate) AS starting,
  CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Open' END AS state,
  'Issuer ' || o_orderpriority AS issuer FROM orders
"""

_COMMITMENTS = """
SELECT '{"nation": ' || s_nationkey || '}' AS scope, s_acctbal AS cost, s_suppkey, s_name,
  TIMESTAMP '2024-01-01' + to_days(s_nationkey) AS starting FROM supplier
"""

_ALL_BUT_LOADED = (
    "bucket_start, bucket_end, uncached_input_tokens, cache_read_input_tokens, output_tokens,"
    " cache_creation_1h_tokens, cache_creation_5m_tokens, web_search_requests, model, api_key_id,"
    " workspace_id, account_id, service_account_id, service_tier, context_window, inference_geo"
)

# Amounts as the decimals they are written as, so that the sum has no rounding of its own.
_BILLED = "coalesce(sum(BilledCost::VARCHAR::DECIMAL(38, 18))::DOUBLE, 0)"

ORACLE: dict[str, str] = {
    # sources and sinks
    "read_csv_all_string": """
        SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
          o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority,
          CASE WHEN o_orderstatus <> 'P'
               THEN o_orderpriority || ', "' || o_orderstatus || '"' END AS remark FROM orders""",
    "read_parquet_merge": """
        SELECT event_id, ts, user_id, event_type,
          CASE WHEN event_type IN ('click', 'error') THEN value END AS value,
          CASE WHEN (event_type IN ('click', 'error')) IS NOT TRUE THEN props END AS props FROM events""",
    "read_ndjson_nested": f"SELECT {_ALL_BUT_LOADED} FROM ({USAGE})",
    "file_inventory": " UNION ALL ".join(
        f"SELECT '{name}.parquet' AS file_name, count(*) AS rows FROM {name}" for name in TABLES
    ),
    "dataset_inventory": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, (SELECT count(*) FROM (DESCRIBE {name})) AS columns FROM {name}"
        for name in TABLES
    ),
    "column_profile": _profile(),
    "stage_generic_feed": """
        SELECT o_totalprice::VARCHAR AS BilledCost, 'acct-' || o_custkey AS BillingAccountId,
          'USD' AS BillingCurrency, 'detail-' || o_orderkey AS InvoiceDetailId,
          'invoice-' || o_custkey AS InvoiceId, o_orderdate::VARCHAR AS InvoiceIssueDate,
          CASE WHEN o_orderstatus IS DISTINCT FROM 'F' THEN 'EUR' END AS PaymentCurrency,
          CASE WHEN o_orderstatus IS DISTINCT FROM 'F' THEN o_totalprice * 0.5 END AS PaymentCurrencyBilledCost,
          TIMESTAMP '2024-06-01' AS _loaded_at, '1.4' AS _focus_version FROM orders""",
    "source_freshness": f"""
        SELECT newest, age_hours, CASE WHEN age_hours <= 24 THEN 'pass' ELSE 'warn' END AS status
        FROM (SELECT newest, (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(newest))
                // 1000000 / 3600.0::DOUBLE AS age_hours
              FROM (SELECT max(_loaded_at) AS newest FROM ({USAGE})))""",
    "currency_seed_antijoin": f"""
        SELECT CurrencyCode, count(*) AS rows FROM ({REPORT})
        WHERE CurrencyCode NOT IN ({_KNOWN_CURRENCY}) GROUP BY 1""",
    "write_read_partitioned": f"{tagged('azure_ai', NATIVE_ROWS)} UNION ALL {tagged('aws_cur', REPORT_ROWS)}",
    "provider_filter": tagged("azure_ai", NATIVE_ROWS),
    # staging
    "stage_nested_usage": USAGE,
    "stage_nested_cost": COST,
    "stage_usage_csv": CREDITS,
    "stage_seats_csv": SEATS,
    "stage_native_feed": NATIVE,
    "stage_prefixed_feed": REPORT,
    # mapping rules
    "map_rule_rename": f"{_MAPPED}, NetUnblendedCost AS Cost FROM ({REPORT})",
    "map_rule_cast": f"{_MAPPED}, UsageAmount::BIGINT AS Amount FROM ({REPORT})",
    "map_rule_coalesce": f"{_MAPPED}, ifnull(NetUnblendedCost, 0) AS Cost FROM ({REPORT})",
    "map_rule_expression": f"{_MAPPED}, UnblendedCost + UsageAmount AS Total FROM ({REPORT})",
    "map_rule_constant": f"{_MAPPED}, 'it''s fixed' AS Text, 1.5::DOUBLE AS Number FROM ({REPORT})",
    "map_rule_concat": f"{_MAPPED}, concat(CurrencyCode, '/', ResourceId, '/', Region) AS Label FROM ({REPORT})",
    "rename_map": f"""{_MAPPED}, UnblendedCost AS Cost, {_NET} AS NetCost,
        UsageAmount::BIGINT AS Amount, 'Hours' AS Unit, concat(ProductCode, ':', Operation) AS Label,
        CASE WHEN UsageAmount <> 0 THEN UnblendedCost / UsageAmount END AS UnitPrice
        FROM ({REPORT})""",
    "apply_mapping": canonical(
        REPORT,
        {
            "BilledCost": "ifnull(NetUnblendedCost, 0)",
            "ListCost": "UnblendedCost",
            "ConsumedQuantity": "UsageAmount::BIGINT",
            "BillingAccountId": "UsageAccountId",
            "ChargeDescription": "concat(ProductCode, ':', CurrencyCode)",
            "ChargePeriodStart": "UsageStartDate",
            "PricingUnit": "'Hours'",
            "ContractedUnitPrice": "CASE WHEN UsageAmount <> 0 THEN UnblendedCost / UsageAmount END",
        },
    ),
    "column_list": _counts(
        REPORT_ROWS,
        [
            f"SELECT {i}::BIGINT AS position, '{line.split()[0]}' AS column_name,"
            f" count({line.split()[0]}) AS filled_rows FROM r"
            for i, line in enumerate(COST_AND_USAGE_TABLE.strip().splitlines(), 1)
        ],
    ),
    "type_map": _type_map(),
    "select_canonical": f"SELECT {', '.join(_NAMES)} FROM ({NATIVE_ROWS})",
    # provider mappings
    "map_ai_usage": AI,
    "map_ai_usage_strict": AI_WHOLE,
    "usage_agg": f"""
        SELECT {_GROUP}, {_METER_SUMS},
          string_agg(DISTINCT service_tier, ',' ORDER BY service_tier) AS service_tiers,
          string_agg(DISTINCT api_key_id, ',' ORDER BY api_key_id) AS api_key_ids
        FROM ({USAGE}) GROUP BY {_GROUP}""",
    "usage_group_members": f"SELECT DISTINCT {_GROUP}, service_tier, api_key_id FROM ({USAGE})",
    "cost_agg": COSTS,
    "unpivot_meters": f"SELECT * EXCLUDE (_loaded_at) FROM ({METERS})",
    "nullsafe_or_join": f"SELECT {_GROUP}, token_slot, quantity, amount_usd FROM ({PRICED})",
    "unit_price_tokens": f"""
        SELECT {_GROUP}, token_slot, {_PAID} AS BilledCost, quantity AS ConsumedQuantity,
          CASE unit WHEN 'Tokens' THEN {_PAID} / quantity END AS ContractedUnitPrice
        FROM ({PRICED})""",
    "charge_category_slot": f"""
        SELECT {_GROUP}, token_slot, CASE unit WHEN 'Requests' THEN 'Fee' ELSE 'Usage' END
          AS ChargeCategory, model || ' - ' || label AS ChargeDescription FROM ({METERS})""",
    "map_seats_and_credits": SEATS_AND_CREDITS,
    "seat_periods": f"""
        SELECT user_name, seat_created_at, CAST(last_day(seat_created_at) AS TIMESTAMP) AS billing_end,
          seat_created_at + INTERVAL 1 MONTH - INTERVAL 1 DAY AS charge_end FROM ({SEATS})""",
    "credit_unit_price": f"""
        SELECT user_name, quantity, net_amount, gross_amount,
          CASE WHEN quantity <> 0 THEN net_amount / quantity END AS ContractedUnitPrice,
          CASE WHEN quantity <> 0 THEN gross_amount / quantity END AS ListUnitPrice
        FROM ({CREDITS})""",
    "map_native": NATIVE_ROWS,
    "map_prefixed": REPORT_ROWS,
    "net_or_list_cost": f"""
        SELECT UsageAccountId, UsageStartDate, LineItemType, {_NET} AS BilledCost,
          {_NET} AS ContractedCost, {_NET} AS EffectiveCost, UnblendedCost AS ListCost
        FROM ({REPORT})""",
    "line_item_category": f"""
        SELECT UsageAccountId, UsageStartDate, LineItemType, {_CATEGORY} AS ChargeCategory
        FROM ({REPORT})""",
    "guarded_unit_price": f"""
        SELECT UsageAccountId, UsageStartDate, LineItemType, {_price(_NET)} AS ContractedUnitPrice,
          {_price('UnblendedCost')} AS ListUnitPrice FROM ({REPORT})""",
    # canonical datasets
    "canonical_one_provider": tagged("aws_cur", REPORT_ROWS),
    "canonical_union": newest(ALL_ROWS),
    "dedup_latest": newest(tagged("aws_cur", REPORT_ROWS)),
    "dedup_report": f"""
        SELECT _provider, rows, kept, rows - kept AS dropped, billed, billed_kept
        FROM (SELECT _provider, count(*) AS rows, {_BILLED} AS billed FROM ({ALL_ROWS}) GROUP BY 1)
        JOIN (SELECT _provider, count(*) AS kept, {_BILLED} AS billed_kept FROM ({newest(ALL_ROWS)})
          GROUP BY 1) USING (_provider)""",
    "billing_period": canonical(
        _PERIODS,
        {
            "BillingPeriodCreated": "created",
            "BillingPeriodEnd": "ending",
            "BillingPeriodStart": "starting",
            "BillingPeriodStatus": "state",
            "InvoiceIssuerName": "issuer",
        },
        "BillingPeriod",
    ),
    "invoice_detail": canonical(
        _CONFORM_INVOICE,
        {
            name: name
            for name in (
                "BilledCost BillingAccountId BillingCurrency InvoiceDetailId InvoiceId"
                " InvoiceIssueDate PaymentCurrency PaymentCurrencyBilledCost"
            ).split()
        },
        "InvoiceDetail",
    ),
    "generic_cost_and_usage": canonical(NATIVE, {name: name for name in _NATIVE_OWN}),
    "contract_commitment": canonical(
        _COMMITMENTS,
        {
            "BillingCurrency": "'USD'",
            "ContractCommitmentApplicability": "scope",
            "ContractCommitmentCost": "cost",
            "ContractCommitmentPeriodStart": "starting",
            "ContractCommitmentId": "'commitment-' || s_suppkey",
            "ContractId": "s_name",
        },
        "ContractCommitment",
    ),
    # checks
    "v_type_string": of_type("reading", "VARCHAR"),
    "v_type_decimal": of_type("tag", "DOUBLE", "BIGINT"),
    "v_type_datetime": of_type("payload", "TIMESTAMP", "DATE"),
    "v_type_json": of_type("reading", "VARCHAR", "JSON"),
    "v_format_string": of_type("ts", "VARCHAR"),
    "v_format_numeric": of_type("amount", "DOUBLE", "BIGINT"),
    "v_format_currency": of_type("user_id", "VARCHAR"),
    "v_format_unit": of_type("reading", "VARCHAR"),
    "v_format_datetime": breaks(
        "seen_at",
        " AND ".join(
            f"try_strptime(seen_at, '{form}') IS NULL"
            for form in ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S%z")
        ),
    ),
    "v_format_datetime_typed": breaks("ts", "try_strptime(ts::VARCHAR, '%Y-%m-%d %H:%M:%S') IS NULL"),
    "v_format_key_value": breaks("tag", "NOT regexp_full_match(tag, '[A-Za-z0-9_]+:[A-Za-z0-9_]+')"),
    "v_format_json": breaks("payload", "payload IS NOT NULL AND try_cast(payload AS JSON) IS NULL"),
    "v_regex_match": breaks("tag", "NOT regexp_matches(tag, '^(click|signup):[0-9]+')"),
    "v_national_currency": breaks("currency", f"currency NOT IN ({_KNOWN_CURRENCY})"),
    "v_greater_or_equal": breaks("reading", "reading < 50"),
    "v_less_or_equal": breaks("reading", "reading > 50"),
    "v_decimal_value": breaks("amount", "amount IS NOT NULL AND try_cast(amount AS DOUBLE) IS NULL"),
    "v_column_equality": breaks("event_type", "event_type <> same_or_other", "same_or_other"),
    "v_multiplication_equals": breaks(
        "reading", "abs(reading * user_id - hundreds) > 100", "user_id", "hundreds"
    ),
    "v_string_ends_with": breaks("tag", "NOT suffix(tag, '7')"),
    "v_not_null": breaks("tag", "tag IS NULL"),
    "v_accepted_values": breaks("currency", "currency NOT IN ('USD', 'XXX')"),
    "v_distinct_count": f"""
        SELECT distinct_count FROM (SELECT count(DISTINCT user_id) AS distinct_count
        FROM ({OBSERVED}) WHERE tag IS NOT NULL) WHERE distinct_count <> 5""",
    "v_column_comparison_gt": breaks("reading", "reading <= target", "target"),
    "v_column_comparison_lt": breaks("reading", "reading >= target", "target"),
    "v_column_comparison_ge": breaks("reading", "reading < target", "target"),
    "v_column_comparison_le": breaks("reading", "reading > target", "target"),
    "v_column_comparison_eq": breaks("event_type", "event_type <> same_or_other", "same_or_other"),
    "v_column_comparison_ne": breaks("event_type", "event_type = same_or_other", "same_or_other"),
    "v_castable": f"""
        WITH r AS ({OBSERVED})
        SELECT 'amount' AS column_name, 'double' AS declared_type, count(amount) AS present,
          count(*) FILTER (WHERE event_type IN ('view', 'purchase')) AS not_castable FROM r
        UNION ALL SELECT 'count', 'bigint', count(*), count(*) FILTER (WHERE event_type = 'view') FROM r
        UNION ALL SELECT 'day', 'date', count(*), count(*) FILTER (WHERE event_type = 'view') FROM r
        UNION ALL SELECT 'moment', 'timestamp', count(*), count(*) FILTER (WHERE event_type = 'click')
          FROM r
        UNION ALL SELECT 'currency', 'string', count(currency), 0 FROM r""",
    "v_schema_assert": f"""
        WITH r AS ({REPORT})
        SELECT '_loaded_at' AS column_name, '{failure_reason("_loaded_at")}' AS failure_reason,
          count(_loaded_at) AS rows_with_value FROM r
        UNION ALL SELECT 'line_item/NetUnblendedRate', '{failure_reason("line_item/NetUnblendedRate")}',
          count(NetUnblendedCost) FROM r
        UNION ALL SELECT 'resourceTags/team', '{failure_reason("resourceTags/team")}', 0""",
    "v_payload_key_drift": """
        SELECT 'code' AS key, count(*) AS rows_with_key FROM events WHERE event_type = 'error'
        UNION ALL SELECT 'unit', count(*) FROM events WHERE event_type = 'view'
        UNION ALL SELECT '(unreadable)', count(*) FROM events WHERE event_type = 'signup'""",
    "v_page_key_drift": """
        SELECT 'page' AS level, 'request_id' AS key, count(*) AS objects FROM events
        UNION ALL SELECT 'result', 'priority', count(*) FROM events WHERE event_type = 'signup'
        UNION ALL SELECT 'cache_creation', 'ephemeral_24h_input_tokens', count(*) FROM events
          WHERE event_type = 'signup'
        UNION ALL SELECT 'server_tool_use', 'code_exec', count(*) FROM events WHERE event_type = 'click'
        UNION ALL SELECT 'page', '(unreadable)', count(*) FROM events WHERE event_type = 'error'""",
    "v_suite_report": suite(FLAWED),
    "v_suite_by_tag": suite(FLAWED, "format", "error"),
    "v_staging_suite": counted_checks(
        "feed",
        [
            ("anthropic_usage", USAGE, _present("bucket_start", "model")),
            ("anthropic_cost", COST, _present("bucket_start", "amount_usd")),
            ("copilot_usage", CREDITS, _present("usage_date", "user_name")),
            ("copilot_billing", SEATS, _present("user_name", "monthly_cost")),
            ("azure_ai", NATIVE, _present("BillingPeriodStart", "BilledCost")),
            ("aws_cur", REPORT, _present("UsageAccountId", "UsageAmount")),
        ],
    ),
    "v_provider_suite": counted_checks(
        "provider",
        [
            ("anthropic", AI, _issued("Anthropic")),
            ("copilot", SEATS_AND_CREDITS, _issued("GitHub")),
            ("azure_ai", NATIVE_ROWS, _issued("Microsoft")),
            ("aws_cur", REPORT_ROWS, _issued("AWS")),
        ],
    ),
    "quarantine_split": f"""
        SELECT CASE WHEN failed = '' THEN 'passed' ELSE 'held' END AS side,
          nullif(failed, '') AS reason, count(*) AS rows FROM ({MARKED}) GROUP BY ALL""",
    "quarantine_rows": f"""
        SELECT SubAccountId, ChargePeriodStart, ChargePeriodEnd, BillingCurrency, BilledCost, failed
        FROM ({MARKED})""",
}
