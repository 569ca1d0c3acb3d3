from __future__ import annotations

import json

import pytest
from pyspark.sql.types import StructType

from tallyloom.plans import nested_ai
from tallyloom.plans.build import Paths
from tallyloom.session import build_session


@pytest.fixture(scope="session")
def scratch(tmp_path_factory):
    return str(tmp_path_factory.mktemp("scratch"))


@pytest.fixture(scope="session")
def spark(scratch):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=scratch,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def shaped(kind, values):
    """An object with the fields of a declared shape, in their order; what has no value is null."""
    return {
        field.name: shaped(field.dataType, values)
        if isinstance(field.dataType, StructType)
        else values.get(field.name)
        for field in kind
    }


def result_shape(page_shape):
    buckets = StructType.fromDDL(page_shape)["data"].dataType.elementType
    return buckets["results"].dataType.elementType


def usage_result(model, workspace, counts, key="k-red", tier="plain"):
    shape = result_shape(nested_ai.USAGE_PAGE)
    meters = (
        "uncached_input_tokens cache_read_input_tokens output_tokens ephemeral_1h_input_tokens"
        " ephemeral_5m_input_tokens web_search_requests"
    ).split()
    words = {"model": model, "workspace_id": workspace, "api_key_id": key, "service_tier": tier}
    return shaped(shape, words | dict(zip(meters, counts, strict=True)))


def cost_result(model, workspace, token_type, amount, cost_type="tokens"):
    shape = result_shape(nested_ai.COST_PAGE)
    words = {"model": model, "workspace_id": workspace, "token_type": token_type}
    return shaped(shape, words | {"amount": amount, "cost_type": cost_type, "currency": "USD"})


def page(start, end, results):
    return {
        "data": [{"starting_at": start, "ending_at": end, "results": results}],
        "has_more": False,
        "next_page": None,
    }


def write_pages(path, pages):
    path.write_text("".join(json.dumps(p) + "\n" for p in pages))
    return str(path)


HOURS = [
    ("2031-05-04T07:00:00Z", "2031-05-04T08:00:00Z"),
    ("2031-05-19T22:00:00Z", "2031-05-19T23:00:00Z"),
]

# The column names of the feeds, in these headers.
SEATS = """user,organization,team,plan_type,seat_created_at,last_activity_at,last_activity_editor,pending_cancellation_date,monthly_cost
ann,org,Blue,business,2028-01-31,2031-04-30T23:15:09Z,pen,,21.50
ben,org,Blue,enterprise,2030-11-12,2031-05-02T06:45:00Z,ink,,44.00
"""

CREDITS = """date,product,sku,model,unit_type,quantity,gross_amount,discount_amount,net_amount,organization,user,team
2031-05-08,P,sku-one,m-one,calls,640,24.00,8.00,16.00,org,ann,Blue
2031-05-08,P,sku-one,m-two,calls,0,7.00,0.00,7.00,org,ben,Blue
2031-05-11,P,sku-one,m-one,calls,30,1.50,0.00,1.50,org,ann,Blue
"""

REPORT_HEADER = (
    "bill/BillingPeriodStartDate,bill/BillingPeriodEndDate,bill/InvoiceId,"
    "line_item/UsageAccountId,line_item/LineItemType,line_item/UsageStartDate,"
    "line_item/UsageEndDate,line_item/ProductCode,line_item/UsageType,line_item/Operation,"
    "line_item/UsageAmount,line_item/UnblendedCost,line_item/NetUnblendedCost,"
    "line_item/CurrencyCode,line_item/LineItemDescription,line_item/ResourceId,"
    "product/ProductName,product/Region,product/InstanceType,pricing/Unit,pricing/RateId,"
    "pricing/Term,line_item/AvailabilityZone"
)


def report_line(kind, day, amount, list_cost, net_cost, description, currency="USD"):
    span = f"2031-05-{day:02d}T06:30:00Z,2031-05-{day:02d}T18:30:00Z"
    return (
        f"{span},,account-seven,{kind},{span},Things,here-Things,Do,{amount},{list_cost},{net_cost},"
        f"{currency},{description},,Label,north,,Pieces,rate,Spot,"
    )


REPORT_LINES = [
    report_line("Usage", 6, "20", "9.0", "7.5", '"first, with comma"'),
    report_line("DiscountedUsage", 6, "20", "9.0", "", "second"),
    report_line("Fee", 6, "0", "11.0", "11.0", "third"),
    report_line("Credit", 6, "4", "0", "0", "fourth"),
    report_line("Tax", 6, "1", "1.0", "1.0", 'fi""fth'.join('""')),
]

# The column names of the export.
NATIVE = """BilledCost,BillingAccountId,BillingAccountName,BillingCurrency,BillingPeriodStart,BillingPeriodEnd,ChargeCategory,ChargeClass,ChargeDescription,ChargeFrequency,ChargePeriodStart,ChargePeriodEnd,ConsumedQuantity,ConsumedUnit,ContractedCost,ContractedUnitPrice,EffectiveCost,ListCost,ListUnitPrice,ResourceId,ResourceType,ServiceCategory,ServiceName,ServiceSubcategory,SkuId,SubAccountId,SubAccountName,SubAccountType,RegionId,MeterCategory,MeterSubCategory,MeterName,ResourceGroup,ResourceLocation
1.5,acct,Account,USD,2025-01-01,2025-01-31,Usage,Regular,tokens in,Usage-Based,2025-01-06,2025-01-07,100,1K Tokens,1.5,0.015,1.5,2.0,0.02,/r/1,deployment,AI,Models,Text,sku-1,sub,Sub,Subscription,eastus,Cat,SubCat,Meter,group,eastus
2.5,acct,Account,USD,2025-01-01,2025-01-31,Usage,Regular,tokens out,Usage-Based,2025-01-06,2025-01-07,50,1K Tokens,2.5,0.05,2.5,3.0,0.06,/r/1,deployment,AI,Models,Text,sku-2,sub,Sub,Subscription,eastus,Cat,SubCat,Meter,group,eastus
"""


@pytest.fixture(scope="session")
def paths(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    usage, cost = [], []
    for start, end in HOURS:
        usage.append(
            page(
                start,
                end,
                [
                    usage_result("m-one", "ws-a", (1230, 77, 640, 910, 333, 9)),
                    usage_result("m-one", "ws-a", (270, 0, 110, 0, 0, 0), key="k-green", tier="later"),
                    usage_result("m-one", None, (45, 0, 8, 0, 0, 3)),
                ],
            )
        )
        usage.append(page(start, end, []))
        cost.append(
            page(
                start,
                end,
                [
                    cost_result("m-one", "ws-a", "uncached_input_tokens", "450"),
                    cost_result("m-one", "ws-a", "uncached_input_tokens", "150"),
                    cost_result("m-one", "ws-a", "cache_creation.ephemeral_1h_input_tokens", "50"),
                    cost_result("m-one", None, "uncached_input_tokens", "30"),
                    cost_result("m-one", None, None, "70", "web_search"),
                    cost_result("m-one", "ws-a", "output_tokens", None),
                    cost_result("m-two", "ws-a", "output_tokens", "9"),
                ],
            )
        )
    feeds = {
        "anthropic_usage": write_pages(root / "usage.json", usage),
        "anthropic_cost": write_pages(root / "cost.json", cost),
    }
    for name, text in (
        ("copilot_usage", CREDITS),
        ("copilot_billing", SEATS),
        ("azure_ai", NATIVE),
        ("aws_cur", "\n".join([REPORT_HEADER, *REPORT_LINES]) + "\n"),
    ):
        (root / f"{name}.csv").write_text(text)
        feeds[name] = str(root / f"{name}.csv")
    (root / "periods.csv").write_text(
        "BillingPeriodStart,BillingPeriodStatus\n2031-05-01T00:00:00Z,open\n"
    )
    (root / "dummy.csv").write_text("dummy_col\n1\n")
    return Paths(
        feeds,
        {"billing_period": str(root / "periods.csv"), "invoice_detail": str(root / "dummy.csv")},
    )
