"""The export whose columns already carry the canonical names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.operators.canonical import Branch, MappedFeed
from tallyloom.operators.staging import stage
from tallyloom.plans.common import direct, vendor

PROVIDER = "azure_ai"

# The export's columns by type.
DOUBLES = (
    "BilledCost ConsumedQuantity ContractedCost ContractedUnitPrice EffectiveCost ListCost"
    " ListUnitPrice"
).split()
DATES = "BillingPeriodStart BillingPeriodEnd ChargePeriodStart ChargePeriodEnd".split()
STRINGS = (
    "BillingAccountId BillingAccountName BillingCurrency ChargeCategory ChargeClass"
    " ChargeDescription ChargeFrequency ConsumedUnit ResourceId ResourceType ServiceCategory"
    " ServiceName ServiceSubcategory SkuId SubAccountId SubAccountName SubAccountType RegionId"
).split()
METERS = "MeterCategory MeterSubCategory MeterName ResourceGroup ResourceLocation".split()

SPEC = {
    **{name: (name, "double") for name in DOUBLES},
    **{name: (name, "date") for name in DATES},
    **{name: (name, "string") for name in STRINGS + METERS},
}

RULES = {
    **direct(DOUBLES + DATES + STRINGS),
    "PricingCurrency": "BillingCurrency",
    "PricingQuantity": "ConsumedQuantity",
    "PricingUnit": "ConsumedUnit",
    **vendor("Microsoft"),
}

EXTRAS = {
    "_meter_category": "MeterCategory",
    "_meter_name": "MeterName",
    "_resource_group": "ResourceGroup",
}


def stage_export(raw: DataFrame, loaded_at: str | None = None) -> DataFrame:
    return stage(raw, SPEC, loaded_at)


def map_export(staged: DataFrame) -> MappedFeed:
    return MappedFeed(PROVIDER, (Branch(staged, RULES, EXTRAS),))
