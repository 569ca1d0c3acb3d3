"""The configured checks: canonical cost and usage, the staged feeds, and the mapped providers."""

from __future__ import annotations

from tallyloom.model import COST_AND_USAGE_TABLE, CURRENCY_CODES
from tallyloom.operators.checks import Check

_TYPE_CHECK = {
    "string": "type_string",
    "double": "type_decimal",
    "timestamp": "type_datetime",
    "json": "type_json",
}

# Severity of the checks on a column, and the last tag, by the column's level.
_LEVELS = {
    "required": ("error", "cost_and_usage"),
    "expected": ("error", "cost_and_usage"),
    "noted": ("warn", "cost_and_usage"),
    "conditional": ("warn", "conditional"),
    "tagged": ("warn", "conditional"),
}


def cost_and_usage_suite() -> list[Check]:
    """The checks of the canonical dataset, from the level and format of each column."""
    suite = []
    for line in COST_AND_USAGE_TABLE.strip().splitlines():
        column, kind, level, formats = line.split()
        severity, last_tag = _LEVELS[level]

        def add(check: str, group: str, **params: object) -> None:
            suite.append(Check(check, column, severity, ("focus", group, last_tag), params))

        if level != "tagged":
            add(_TYPE_CHECK[kind], "type")
        for name in formats.split(",") if formats != "-" else ():
            if name == "national_currency":
                add(name, "currency", values=CURRENCY_CODES)
            else:
                add(f"format_{name}", "format")
        if level == "required":
            add("not_null", "presence")
    return suite


# Staged columns that must be present, per feed.
STAGED_REQUIRED = {
    "cost_and_usage": "_loaded_at",
    "billing_period": "_loaded_at",
    "contract_commitment": "_loaded_at",
    "invoice_detail": "_loaded_at",
    "anthropic_usage": "bucket_start model",
    "anthropic_cost": "bucket_start amount_usd",
    "copilot_usage": "usage_date user_name",
    "copilot_billing": "user_name monthly_cost",
    "azure_ai": "BillingPeriodStart BilledCost",
    "aws_cur": "UsageAccountId UsageAmount",
}


def staging_suite(feed: str) -> list[Check]:
    return [Check("not_null", column) for column in STAGED_REQUIRED[feed].split()]


# The issuer of each provider's charges and the tag of its checks.
ISSUERS = {
    "anthropic": ("Anthropic", "anthropic"),
    "copilot": ("GitHub", "copilot"),
    "azure_ai": ("Microsoft", "azure"),
    "aws_cur": ("AWS", "aws"),
}


def provider_suite(provider: str) -> list[Check]:
    issuer, tag = ISSUERS[provider]
    expected = (
        ("InvoiceIssuerName", issuer, "provider_check"),
        ("ServiceProviderName", issuer, "provider_check"),
        ("BillingCurrency", "USD", "currency"),
    )
    return [
        Check("accepted_values", column, "error", ("intermediate", tag, group), {"values": (value,)})
        for column, value, group in expected
    ]
