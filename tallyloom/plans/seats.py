"""Seat subscriptions and usage credits of one provider."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.functions import guarded_ratio, month_end, plus_month_less_day
from tallyloom.operators.canonical import Branch, MappedFeed
from tallyloom.operators.mapping import Constant, Expression
from tallyloom.operators.staging import stage, staging_spec
from tallyloom.plans.common import (
    AI_SERVICE,
    REGULAR,
    US_DOLLAR,
    USAGE,
    USAGE_BASED,
    same,
    vendor,
)

PROVIDER = "copilot"

# Staged column, feed column, type.
CREDITS_SPEC = staging_spec("""
usage_date       date             date
product          product          string
sku              sku              string
model            model            string
unit_type        unit_type        string
quantity         quantity         bigint
gross_amount     gross_amount     double
discount_amount  discount_amount  double
net_amount       net_amount       double
organization     organization     string
user_name        user             string
team             team             string
""")

# Staged column, feed column, type.
SEATS_SPEC = staging_spec("""
user_name             user                  string
organization          organization          string
team                  team                  string
plan_type             plan_type             string
seat_created_at       seat_created_at       date
last_activity_at      last_activity_at      timestamp
last_activity_editor  last_activity_editor  string
monthly_cost          monthly_cost          double
""")

# The account both charge kinds are billed to.
_ACCOUNT = {
    "BillingAccountId": Constant("myorg"),
    "BillingAccountName": Constant("My Organization"),
    **same(US_DOLLAR, "BillingCurrency", "PricingCurrency"),
    "ChargeCategory": USAGE,
    "ChargeClass": REGULAR,
    "ServiceCategory": AI_SERVICE,
    "ServiceName": Constant("GitHub Copilot"),
    **same("user_name", "SubAccountId", "SubAccountName"),
    "SubAccountType": Constant("User"),
    **vendor("GitHub"),
}

# A seat bills from its creation; the billing period closes with the calendar month, the charge
# period after one month.
SEAT_RULES = {
    **_ACCOUNT,
    **same(
        "monthly_cost",
        "BilledCost",
        "ContractedCost",
        "EffectiveCost",
        "ListCost",
        "ContractedUnitPrice",
    ),
    **same("seat_created_at", "BillingPeriodStart", "ChargePeriodStart"),
    "BillingPeriodEnd": "billing_end",
    "ChargePeriodEnd": "charge_end",
    "ChargeDescription": Expression("'GitHub Copilot ' || plan_type || ' - ' || user_name"),
    "ChargeFrequency": Constant("Recurring"),
    **same(Constant(1.0, "double"), "ConsumedQuantity", "PricingQuantity"),
    **same(Constant("Seats"), "ConsumedUnit", "PricingUnit"),
    "ServiceSubcategory": "plan_type",
}

CREDIT_RULES = {
    **_ACCOUNT,
    **same("net_amount", "BilledCost", "ContractedCost", "EffectiveCost"),
    "ListCost": "gross_amount",
    "ContractedUnitPrice": Expression(guarded_ratio("net_amount", "quantity")),
    "ListUnitPrice": Expression(guarded_ratio("gross_amount", "quantity")),
    **same(
        "usage_date",
        "BillingPeriodStart",
        "BillingPeriodEnd",
        "ChargePeriodStart",
        "ChargePeriodEnd",
    ),
    "ChargeDescription": Expression("'GitHub Copilot AI Credits - ' || model"),
    "ChargeFrequency": USAGE_BASED,
    **same("quantity", "ConsumedQuantity", "PricingQuantity"),
    **same("unit_type", "ConsumedUnit", "PricingUnit"),
    "ServiceSubcategory": "model",
    "SkuId": "sku",
}

SEAT_EXTRAS = {"_charge_type": Constant("seat"), "_plan_type": "plan_type"}
CREDIT_EXTRAS = {"_charge_type": Constant("ai_credits"), "_model": "model"}


def stage_seats(raw: DataFrame, loaded_at: str | None = None) -> DataFrame:
    return stage(raw, SEATS_SPEC, loaded_at)


def stage_credits(raw: DataFrame, loaded_at: str | None = None) -> DataFrame:
    return stage(raw, CREDITS_SPEC, loaded_at)


def seat_periods(seats: DataFrame) -> DataFrame:
    return seats.selectExpr(
        "*",
        f"{month_end('seat_created_at')} as billing_end",
        f"{plus_month_less_day('seat_created_at')} as charge_end",
    )


def map_seats_and_credits(seats: DataFrame, credits: DataFrame) -> MappedFeed:
    return MappedFeed(
        PROVIDER,
        (
            Branch(seat_periods(seats), SEAT_RULES, SEAT_EXTRAS),
            Branch(credits, CREDIT_RULES, CREDIT_EXTRAS),
        ),
    )
