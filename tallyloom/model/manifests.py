"""Which columns each feed may carry: after staging, and in the raw file.

The staged lists describe what staging produces, so they can only catch a staging change. A column
the provider adds shows up in the raw frame alone, which is why there is a raw list for every feed.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Manifest:
    allowed: frozenset[str] = frozenset()
    ignored: frozenset[str] = frozenset()

    @property
    def known(self) -> frozenset[str]:
        return self.allowed | self.ignored


def _manifest(allowed: str, ignored: str = "") -> Manifest:
    return Manifest(frozenset(allowed.split()), frozenset(ignored.split()))


# Staged columns per feed.
STAGED_MANIFESTS: dict[str, Manifest] = {
    "anthropic_usage": _manifest(
        """
        bucket_start bucket_end uncached_input_tokens cache_read_input_tokens output_tokens
        cache_creation_1h_tokens cache_creation_5m_tokens web_search_requests model api_key_id
        workspace_id account_id service_account_id service_tier context_window inference_geo
        _loaded_at
        """,
        "has_more next_page",
    ),
    "anthropic_cost": _manifest(
        """
        bucket_start bucket_end amount_cents amount_usd currency cost_type description model
        token_type workspace_id service_tier context_window inference_geo _loaded_at
        """,
        "has_more next_page",
    ),
    "copilot_usage": _manifest(
        """
        usage_date product sku model unit_type quantity gross_amount discount_amount net_amount
        organization user_name team _loaded_at
        """
    ),
    "copilot_billing": _manifest(
        """
        user_name organization team plan_type seat_created_at last_activity_at
        last_activity_editor monthly_cost _loaded_at
        """
    ),
    "aws_cur": _manifest(
        """
        BillingPeriodStartDate BillingPeriodEndDate UsageAccountId LineItemType UsageStartDate
        UsageEndDate ProductCode UsageType Operation UsageAmount UnblendedCost NetUnblendedCost
        CurrencyCode LineItemDescription ResourceId ProductName Region InstanceType PricingUnit
        PricingTerm _loaded_at
        """
    ),
    "azure_ai": _manifest(
        """
        BilledCost BillingAccountId BillingAccountName BillingCurrency BillingPeriodStart
        BillingPeriodEnd ChargeCategory ChargeClass ChargeDescription ChargeFrequency
        ChargePeriodStart ChargePeriodEnd ConsumedQuantity ConsumedUnit ContractedCost
        ContractedUnitPrice EffectiveCost ListCost ListUnitPrice ResourceId ResourceType
        ServiceCategory ServiceName ServiceSubcategory SkuId SubAccountId SubAccountName
        SubAccountType RegionId MeterCategory MeterSubCategory MeterName ResourceGroup
        ResourceLocation _loaded_at
        """
    ),
}

# Raw columns per feed; the ignored ones are delivered but not staged.
RAW_MANIFESTS: dict[str, Manifest] = {
    "anthropic_usage": _manifest("data", "has_more next_page"),
    "anthropic_cost": _manifest("data", "has_more next_page"),
    "copilot_usage": _manifest(
        """
        date product sku model unit_type quantity gross_amount discount_amount net_amount
        organization user team
        """
    ),
    "copilot_billing": _manifest(
        """
        user organization team plan_type seat_created_at last_activity_at last_activity_editor
        monthly_cost
        """,
        "pending_cancellation_date",
    ),
    "aws_cur": _manifest(
        """
        bill/BillingPeriodStartDate bill/BillingPeriodEndDate line_item/UsageAccountId
        line_item/LineItemType line_item/UsageStartDate line_item/UsageEndDate
        line_item/ProductCode line_item/UsageType line_item/Operation line_item/UsageAmount
        line_item/UnblendedCost line_item/NetUnblendedCost line_item/CurrencyCode
        line_item/LineItemDescription line_item/ResourceId product/ProductName product/Region
        product/InstanceType pricing/Unit pricing/Term
        """,
        "bill/InvoiceId pricing/RateId line_item/AvailabilityZone",
    ),
    "azure_ai": Manifest(STAGED_MANIFESTS["azure_ai"].allowed - {"_loaded_at"}),
}


def manifest(feed: str, *, raw: bool = False) -> Manifest:
    """The manifest of a feed; an unknown feed has an empty one, so every column is unexpected."""
    return (RAW_MANIFESTS if raw else STAGED_MANIFESTS).get(feed, Manifest())
