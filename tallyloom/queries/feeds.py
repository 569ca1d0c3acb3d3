"""Billing feeds derived from the given tables, every row of them, one feed row or page per table row.

The derivations put in what real feeds get wrong: missing values, unknown currencies, empty result
lists, zero quantities, several versions of one charge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions import quoted, record

# The shapes of the given tables that the feeds are derived from.
_SHAPES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = tuple(_SHAPES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by its declared shape; a file that lacks a declared column is an error."""
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.schema(_SHAPES[name]).parquet(path)
    missing = set(df.columns) - set(spark.read.parquet(path).columns)
    if missing:
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    return df


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} as {quoted(name)}" for name, sql in columns.items()])


def _as_text(df: DataFrame, keep: tuple[str, ...] = ("_loaded_at",)) -> DataFrame:
    return _select(
        df,
        {
            name: quoted(name) if name in keep else f"cast({quoted(name)} as string)"
            for name in df.columns
        },
    )


_NO_TEXT = "cast(null as string)"


def report(spark: SparkSession, sf_dir: str, as_text: bool = False) -> DataFrame:
    """A prefixed cost report with one line per ``lineitem`` row."""
    kind = (
        "case l_returnflag || l_linestatus when 'AO' then 'Usage' when 'RO' then 'Fee'"
        " when 'RF' then 'Credit' when 'AF' then 'Tax' else 'DiscountedUsage' end"
    )
    currency = "case l_linenumber when 1 then 'EUR' when 2 then 'usd' when 3 then null else 'USD' end"
    length = "if(l_linenumber = 4, interval '23:59:59.5' hour to second, interval '23:59:59' hour to second)"
    columns = {
        "bill/BillingPeriodStartDate": "cast(trunc(l_shipdate, 'month') as timestamp_ntz)",
        "bill/BillingPeriodEndDate": "cast(last_day(l_shipdate) as timestamp_ntz)",
        "bill/InvoiceId": _NO_TEXT,
        "line_item/UsageAccountId": "'acct-' || l_suppkey",
        "line_item/LineItemType": kind,
        "line_item/UsageStartDate": "l_shipdate",
        "line_item/UsageEndDate": f"l_shipdate + {length}",
        "line_item/ProductCode": "'service-' || l_returnflag",
        "line_item/UsageType": "l_linestatus || '-' || l_linenumber",
        "line_item/Operation": "'part-' || l_partkey",
        "line_item/UsageAmount": "if(l_linenumber = 7, 0.0D, l_quantity)",
        "line_item/UnblendedCost": "if(l_tax = 0.08D, 0.0D, l_extendedprice)",
        "line_item/NetUnblendedCost": "if(l_discount > 0, l_extendedprice * (1 - l_discount), null)",
        "line_item/CurrencyCode": currency,
        "line_item/LineItemDescription": "'Lines of status ' || l_linestatus",
        "line_item/ResourceId": "if(l_linenumber > 2, 'order-' || l_orderkey, null)",
        "product/ProductName": "'Service ' || l_returnflag",
        "product/Region": "'region-' || l_linenumber",
        "product/InstanceType": _NO_TEXT,
        "pricing/Unit": "'Units'",
        "pricing/RateId": "'rate-' || l_partkey",
        "pricing/Term": "if(l_discount > 0, 'Reserved', 'OnDemand')",
        "line_item/AvailabilityZone": _NO_TEXT,
        "_loaded_at": "l_shipdate + make_dt_interval(l_linenumber)",
    }
    df = _select(table(spark, sf_dir, "lineitem"), columns)
    return _as_text(df) if as_text else df


_WORKSPACE = "case when user_id % 10 > 0 then 'ws-' || user_id % 10 end"
_PLACE = "if(event_id % 2 = 0, 'us', 'eu')"


def _pages(events: DataFrame, results: str) -> DataFrame:
    hour = "substring(cast(ts as string), 1, 13) || ':00:00'"
    later = f"cast({hour} as timestamp_ntz) + if(event_id % 11 = 0, interval 2 hour, interval 1 hour)"
    bucket = record(
        {
            "starting_at": f"replace({hour}, ' ', 'T') || 'Z'",
            "ending_at": f"replace(cast({later} as string), ' ', 'T') || 'Z'",
            "results": results,
        }
    )
    return _select(
        events,
        {
            "has_more": "false",
            "next_page": _NO_TEXT,
            "data": f"array({bucket})",
            "_loaded_at": "ts",
        },
    )


def _usage_result(tier: str, counts: dict[str, str]) -> str:
    number = {name: f"cast({sql} as bigint)" for name, sql in counts.items()}
    cache = {
        "ephemeral_1h_input_tokens": number["hour"],
        "ephemeral_5m_input_tokens": number["minutes"],
    }
    return record(
        {
            "uncached_input_tokens": number["uncached"],
            "cache_read_input_tokens": number["read"],
            "output_tokens": number["output"],
            "cache_creation": record(cache),
            "server_tool_use": record({"web_search_requests": number["searches"]}),
            "model": "event_type",
            "api_key_id": "'key-' || user_id % 5",
            "workspace_id": _WORKSPACE,
            "account_id": "'acct-1'",
            "service_account_id": _NO_TEXT,
            "service_tier": f"'{tier}'",
            "context_window": "'200000'",
            "inference_geo": _PLACE,
        }
    )


def usage_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per event: two results for a signup, none for an error, else one."""
    standard = _usage_result(
        "standard",
        {
            "uncached": "floor(value * 100)",
            "read": "event_id % 4",
            "output": "user_id",
            "hour": "if(event_type = 'purchase', floor(value), 0)",
            "minutes": "if(event_type <> 'view', event_id % 3, null)",
            "searches": "if(event_type = 'click', 1, 0)",
        },
    )
    batch = _usage_result(
        "batch",
        {
            "uncached": "1",
            "read": "0",
            "output": "event_id % 7",
            "hour": "null",
            "minutes": "0",
            "searches": "2",
        },
    )
    results = (
        f"case event_type when 'error' then slice(array({standard}), 1, 0)"
        f" when 'signup' then array({standard}, {batch}) else array({standard}) end"
    )
    return _pages(table(spark, sf_dir, "events"), results)


def cost_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per event with one cost result; views have no amount."""
    token_type = (
        "case event_id % 6 when 0 then 'uncached_input_tokens' when 1 then 'cache_read_input_tokens'"
        " when 2 then 'cache_creation.ephemeral_1h_input_tokens'"
        " when 3 then 'cache_creation.ephemeral_5m_input_tokens' when 4 then 'output_tokens' end"
    )
    cost_type = (
        "case when event_id % 6 = 5 then 'web_search' when event_id % 13 = 0 then 'manual'"
        " else 'tokens' end"
    )
    cents = "cast(cast(floor(value * 100) as bigint) as string)"
    result = record(
        {
            "amount": f"if(event_type <> 'view', {cents}, null)",
            "currency": "'USD'",
            "cost_type": cost_type,
            "description": "'Usage costs'",
            "model": "event_type",
            "token_type": token_type,
            "workspace_id": _WORKSPACE,
            "service_tier": "'standard'",
            "context_window": "'200000'",
            "inference_geo": _PLACE,
        }
    )
    return _pages(table(spark, sf_dir, "events"), f"array({result})")


def seats(spark: SparkSession, sf_dir: str, as_text: bool = False) -> DataFrame:
    """A seat per customer, created on the day of the first order."""
    active = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg({"o_orderdate": "min", "o_orderkey": "count"})
        .withColumnsRenamed({"min(o_orderdate)": "first", "count(o_orderkey)": "orders"})
    )
    customer = table(spark, sf_dir, "customer")
    joined = customer.join(active, customer["c_custkey"] == active["o_custkey"], "left")
    plan = "if(c_mktsegment in ('BUILDING', 'MACHINERY'), 'enterprise', 'business')"
    last = "first + make_dt_interval(cast(orders as int))"
    columns = {
        "user": "c_name",
        "organization": "'org'",
        "team": "c_mktsegment",
        "plan_type": plan,
        "seat_created_at": "cast(first as date)",
        "last_activity_at": last,
        "last_activity_editor": "'editor'",
        "pending_cancellation_date": _NO_TEXT,
        "monthly_cost": f"if({plan} = 'enterprise', 39.0D, 19.0D)",
        "_loaded_at": last,
    }
    df = _select(joined, columns)
    return _as_text(df) if as_text else df


def credits(spark: SparkSession, sf_dir: str, as_text: bool = False) -> DataFrame:
    """A usage credit per order; some have a zero quantity."""
    discount = "if(o_orderstatus = 'F', 100.0D, 0.0D)"
    columns = {
        "date": "cast(o_orderdate as date)",
        "product": "'Assistant'",
        "sku": "'sku-' || o_orderstatus",
        "model": "o_orderpriority",
        "unit_type": "'requests'",
        "quantity": "o_orderkey % 7",
        "gross_amount": "o_totalprice",
        "discount_amount": discount,
        "net_amount": f"o_totalprice - {discount}",
        "organization": "'org'",
        "user": "'user-' || o_custkey",
        "team": "o_orderstatus",
        "_loaded_at": "o_orderdate",
    }
    df = _select(table(spark, sf_dir, "orders"), columns)
    return _as_text(df) if as_text else df


def native(spark: SparkSession, sf_dir: str, as_text: bool = False) -> DataFrame:
    """A charge per part, in columns that already have their canonical names."""
    texts = {
        "BillingAccountId": "p_brand",
        "BillingAccountName": "'Account of ' || p_brand",
        "BillingCurrency": "if(p_size = 50, 'GBP', 'USD')",
        "ChargeCategory": "'Usage'",
        "ChargeClass": "'Regular'",
        "ChargeDescription": "p_name",
        "ChargeFrequency": "'Usage-Based'",
        "ConsumedUnit": "'1K Tokens'",
        "ResourceId": "'/resource/' || p_partkey",
        "ResourceType": "lower(p_type)",
        "ServiceCategory": "'AI and Machine Learning'",
        "ServiceName": "p_type",
        "ServiceSubcategory": "case when p_size > 10 then 'Text' end",
        "SkuId": "'sku-' || p_partkey",
        "SubAccountId": "p_brand",
        "SubAccountName": "p_brand",
        "SubAccountType": "'Subscription'",
        "RegionId": "'region-' || p_size % 4",
        "MeterCategory": "p_type",
        "MeterSubCategory": "p_brand",
        "MeterName": "p_name",
        "ResourceGroup": "'group-' || p_size % 3",
        "ResourceLocation": "'region-' || p_size % 4",
    }
    doubles = {
        "BilledCost": "p_retailprice",
        "ConsumedQuantity": "cast(p_size as double)",
        "ContractedCost": "p_retailprice",
        "ContractedUnitPrice": "p_retailprice / p_size",
        "EffectiveCost": "p_retailprice",
        "ListCost": "p_retailprice * 2",
        "ListUnitPrice": "p_retailprice * 2 / p_size",
    }
    dates = {
        "BillingPeriodStart": "date'2024-01-01'",
        "BillingPeriodEnd": "date'2024-01-31'",
        "ChargePeriodStart": "date_add(date'2024-01-01', p_size)",
        "ChargePeriodEnd": "date_add(date'2024-01-02', p_size)",
    }
    loaded = {"_loaded_at": "timestamp_ntz'2024-02-01 00:00:00' + make_dt_interval(p_size)"}
    df = _select(table(spark, sf_dir, "part"), texts | doubles | dates | loaded)
    return _as_text(df) if as_text else df


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with text columns of mixed quality, for the checks."""
    columns = {
        "event_id": "event_id",
        "ts": "ts",
        "user_id": "user_id",
        "event_type": "event_type",
        "reading": "case when event_type <> 'error' then value end",
        "tag": "case event_type when 'error' then null when 'view' then event_type || ' : ' || user_id"
        " else event_type || ':' || user_id end",
        "payload": "case event_type when 'click' then replace(props, '}', '')"
        " when 'signup' then props || 'x' when 'error' then null else props end",
        "seen_at": "case event_type when 'click' then date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        " when 'view' then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
        " when 'signup' then date_format(ts, 'yyyy-M-d')"
        " when 'purchase' then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
        " else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end",
        "amount": "case event_type when 'view' then 'n/a' when 'signup' then '-1.5e3'"
        " when 'purchase' then value || ' USD' when 'error' then null else cast(value as string) end",
        "currency": "case user_id % 6 when 0 then null when 1 then 'usd' when 2 then 'USD'"
        " when 3 then 'XXX' when 4 then 'EUR' else 'ZZZ' end",
        "target": "value + case event_id % 3 when 0 then 0 when 1 then 1 else -1 end",
        "same_or_other": "case user_id % 3 when 0 then event_type when 1 then null else 'other' end",
        "hundreds": "floor(value)",
    }
    return _select(table(spark, sf_dir, "events"), columns)


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A billing period per order, with its canonical column names, as text."""
    columns = {
        "BillingPeriodCreated": "o_orderdate",
        "BillingPeriodEnd": "cast(last_day(o_orderdate) as timestamp_ntz)",
        "BillingPeriodStart": "cast(trunc(o_orderdate, 'month') as timestamp_ntz)",
        "BillingPeriodStatus": "if(o_orderstatus = 'F', 'Closed', 'Open')",
        "InvoiceIssuerName": "'Issuer ' || o_orderpriority",
    }
    return _as_text(_select(table(spark, sf_dir, "orders"), columns))


def invoices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Invoice details as text (closed orders) and typed (the others); the typed side has more columns."""
    common = {
        "BilledCost": "o_totalprice",
        "BillingAccountId": "'acct-' || o_custkey",
        "BillingCurrency": "'USD'",
        "InvoiceDetailId": "'detail-' || o_orderkey",
        "InvoiceId": "'invoice-' || o_custkey",
        "InvoiceIssueDate": "o_orderdate",
    }
    more = {"PaymentCurrency": "'EUR'", "PaymentCurrencyBilledCost": "o_totalprice * 0.5D"}
    orders = table(spark, sf_dir, "orders")
    closed = orders.where("o_orderstatus <=> 'F'")
    others = orders.where("not (o_orderstatus <=> 'F')")
    return _as_text(_select(closed, common)), _select(others, common | more)


def commitments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract commitment per supplier, as text."""
    columns = {
        "BillingCurrency": "'USD'",
        "ContractCommitmentApplicability": "'{\"nation\": ' || s_nationkey || '}'",
        "ContractCommitmentCost": "s_acctbal",
        "ContractCommitmentPeriodStart": "timestamp_ntz'2024-01-01 00:00:00'"
        " + make_dt_interval(s_nationkey)",
        "ContractCommitmentId": "'commitment-' || s_suppkey",
        "ContractId": "s_name",
    }
    return _as_text(_select(table(spark, sf_dir, "supplier"), columns))
