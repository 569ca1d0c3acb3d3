"""The cost report whose column names carry a section prefix, as in ``line_item/UsageAmount``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.functions import guarded_ratio
from tallyloom.operators.canonical import Branch, MappedFeed
from tallyloom.operators.mapping import Constant, Expression
from tallyloom.operators.staging import stage, staging_spec
from tallyloom.plans.common import AI_SERVICE, REGULAR, USAGE_BASED, same, vendor

PROVIDER = "aws_cur"

# Staged column, report column, type.
SPEC = staging_spec("""
BillingPeriodStartDate  bill/BillingPeriodStartDate    timestamp
BillingPeriodEndDate    bill/BillingPeriodEndDate      timestamp
UsageAccountId          line_item/UsageAccountId       string
LineItemType            line_item/LineItemType         string
UsageStartDate          line_item/UsageStartDate       timestamp
UsageEndDate            line_item/UsageEndDate         timestamp
ProductCode             line_item/ProductCode          string
UsageType               line_item/UsageType            string
Operation               line_item/Operation            string
UsageAmount             line_item/UsageAmount          double
UnblendedCost           line_item/UnblendedCost        double
NetUnblendedCost        line_item/NetUnblendedCost     double
CurrencyCode            line_item/CurrencyCode         string
LineItemDescription     line_item/LineItemDescription  string
ResourceId              line_item/ResourceId           string
ProductName             product/ProductName            string
Region                  product/Region                 string
InstanceType            product/InstanceType           string
PricingUnit             pricing/Unit                   string
PricingTerm             pricing/Term                   string
""")

# Line item types that are not plain usage.
CATEGORY_OF = {"Fee": "Fee", "Credit": "Adjustment"}

NET_OR_LIST = "coalesce(NetUnblendedCost, UnblendedCost)"


def _category() -> Expression:
    branches = " ".join(f"when '{kind}' then '{name}'" for kind, name in CATEGORY_OF.items())
    return Expression(f"case LineItemType {branches} else 'Usage' end")


def _unit_price(cost: str) -> Expression:
    """A zero cost has no unit price, just as a zero amount has none."""
    return Expression(guarded_ratio(f"nullif({cost}, 0)", "UsageAmount"))


RULES = {
    **same(Expression(NET_OR_LIST), "BilledCost", "ContractedCost", "EffectiveCost"),
    "ListCost": "UnblendedCost",
    "ContractedUnitPrice": _unit_price(NET_OR_LIST),
    "ListUnitPrice": _unit_price("UnblendedCost"),
    **same("UsageAccountId", "BillingAccountId", "BillingAccountName", "SubAccountId"),
    "SubAccountType": Constant("Account"),
    **same("CurrencyCode", "BillingCurrency", "PricingCurrency"),
    "BillingPeriodStart": "BillingPeriodStartDate",
    "BillingPeriodEnd": "BillingPeriodEndDate",
    "ChargePeriodStart": "UsageStartDate",
    "ChargePeriodEnd": "UsageEndDate",
    "ChargeCategory": _category(),
    "ChargeClass": REGULAR,
    "ChargeDescription": "LineItemDescription",
    "ChargeFrequency": USAGE_BASED,
    **same("UsageAmount", "ConsumedQuantity", "PricingQuantity"),
    **same("PricingUnit", "ConsumedUnit", "PricingUnit"),
    "ServiceCategory": AI_SERVICE,
    "ServiceName": "ProductCode",
    "ServiceSubcategory": "UsageType",
    "ResourceId": "ResourceId",
    "RegionId": "Region",
    **vendor("AWS"),
}

EXTRAS = {
    "_line_item_type": "LineItemType",
    "_operation": "Operation",
    "_pricing_term": "PricingTerm",
}


def stage_report(raw: DataFrame, loaded_at: str | None = None) -> DataFrame:
    return stage(raw, SPEC, loaded_at)


def map_report(staged: DataFrame) -> MappedFeed:
    return MappedFeed(PROVIDER, (Branch(staged, RULES, EXTRAS),))
