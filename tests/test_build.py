"""The whole run over small feed files of every shape."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyloom.model import column_list
from tallyloom.plans.build import build
from tallyloom.sources import read_partitioned


@pytest.fixture(scope="module")
def run(spark, paths):
    return build(spark, paths)


@pytest.fixture(scope="module")
def rows(run):
    return [row.asDict() for row in run.canonical["CostAndUsage"].collect()]


def test_columns_and_counts(run, rows):
    names = run.canonical["CostAndUsage"].columns
    assert names == [*column_list("CostAndUsage"), "_loaded_at", "_provider"]
    assert len(names) == 64
    counts = {}
    for row in rows:
        counts[row["_provider"]] = counts.get(row["_provider"], 0) + 1
    # per hour: six meters for one workspace, three for the one without a name
    assert counts == {"anthropic": 18, "copilot": 5, "azure_ai": 2, "aws_cur": 5}


def pick(rows, provider, **wanted):
    found = [
        row
        for row in rows
        if row["_provider"] == provider and all(row[k] == v for k, v in wanted.items())
    ]
    assert len(found) == 1, found
    return found[0]


def test_nested_usage_meets_its_cost(rows):
    hour = dt.datetime(2031, 5, 4, 7)
    row = pick(
        rows,
        "anthropic",
        ChargePeriodStart=hour,
        SubAccountId="ws-a",
        ChargeDescription="m-one - Uncached Input Tokens",
    )
    assert row["ConsumedQuantity"] == 1500.0
    assert row["BilledCost"] == row["ListCost"] == 6.0
    assert row["ContractedUnitPrice"] == 6.0 / 1500
    assert row["ChargeCategory"] == "Usage"
    fee = pick(
        rows,
        "anthropic",
        ChargePeriodStart=hour,
        SubAccountId=None,
        ChargeDescription="m-one - Web Search Requests",
    )
    assert (fee["ChargeCategory"], fee["BilledCost"]) == ("Fee", 0.7)
    assert fee["ContractedUnitPrice"] is None
    free = pick(
        rows,
        "anthropic",
        ChargePeriodStart=hour,
        SubAccountId="ws-a",
        ChargeDescription="m-one - Output Tokens",
    )
    assert (free["BilledCost"], free["ContractedUnitPrice"]) == (0.0, 0.0)


def test_seats_and_credits(rows):
    seat = pick(rows, "copilot", SubAccountId="ann", ChargeFrequency="Recurring")
    assert seat["BillingPeriodStart"] == dt.datetime(2028, 1, 31)
    assert seat["BillingPeriodEnd"] == dt.datetime(2028, 1, 31)
    assert seat["ChargePeriodEnd"] == dt.datetime(2028, 2, 28)
    assert seat["ChargeDescription"] == "GitHub Copilot business - ann"
    assert (seat["ConsumedQuantity"], seat["ConsumedUnit"]) == (1.0, "Seats")
    idle = pick(rows, "copilot", SubAccountId="ben", ChargeFrequency="Usage-Based")
    assert idle["ContractedUnitPrice"] is None and idle["ListUnitPrice"] is None
    busy = pick(rows, "copilot", SubAccountId="ann", ConsumedQuantity=640.0)
    assert busy["ContractedUnitPrice"] == 16.0 / 640
    assert busy["ListUnitPrice"] == 24.0 / 640
    assert busy["SkuId"] == "sku-one"


def test_report_costs_and_categories(rows):
    by = {row["ChargeDescription"]: row for row in rows if row["_provider"] == "aws_cur"}
    assert by["first, with comma"]["BilledCost"] == 7.5
    assert by["first, with comma"]["ListUnitPrice"] == 0.45
    assert by["second"]["BilledCost"] == by["second"]["ListCost"] == 9.0
    assert by["third"]["ContractedUnitPrice"] is None
    assert by["fourth"]["ContractedUnitPrice"] is None
    categories = {name: row["ChargeCategory"] for name, row in by.items()}
    assert categories == {
        "first, with comma": "Usage",
        "second": "Usage",
        "third": "Fee",
        "fourth": "Adjustment",
        'fi"fth': "Usage",
    }


def test_native_copies_and_derives(rows):
    row = pick(rows, "azure_ai", SkuId="sku-1")
    assert (row["PricingCurrency"], row["PricingQuantity"], row["PricingUnit"]) == (
        "USD",
        100.0,
        "1K Tokens",
    )
    assert row["BillingPeriodEnd"] == dt.datetime(2025, 1, 31)


def test_one_provider_keeps_duplicates(spark, paths):
    one = build(spark, paths, provider="aws_cur")
    twice = one.canonical["CostAndUsage"].union(one.canonical["CostAndUsage"])
    assert one.canonical["CostAndUsage"].count() == 5
    assert twice.count() == 10
    assert one.canonical["CostAndUsage"].select("_provider").distinct().head()[0] == "aws_cur"


def test_extra_columns_stay_on_the_mapped_views(run):
    assert {"_charge_type", "_plan_type", "_model"} <= set(run.mapped["copilot"].columns)
    seats = run.mapped["copilot"].where("_charge_type = 'seat'")
    assert seats.where(F.col("_model").isNull()).count() == 2
    assert run.mapped["anthropic"].columns[-2:] == ["_token_type", "_token_label"]


def test_other_datasets(run):
    periods = run.canonical["BillingPeriod"].collect()
    assert periods[0]["BillingPeriodStart"] == dt.datetime(2031, 5, 1)
    assert periods[0]["BillingPeriodCreated"] is None
    for dataset, width in (("InvoiceDetail", 22), ("ContractCommitment", 30)):
        assert run.canonical[dataset].count() == 0
        assert len(run.canonical[dataset].columns) == width


def test_all_configured_checks_run_and_pass(run):
    result = run.check().collect()
    # 100 canonical, 12 per provider, and the present-value checks of eight staged feeds
    assert len(result) == 100 + 12 + 14
    broken = [(row["dataset"], row["column_name"], row["violations"]) for row in result if row["violations"]]
    # the feed has one result without an amount in each hour
    assert broken == [("stg_anthropic_cost", "amount_usd", 2)]
    assert {row["status"] for row in result if not row["violations"]} == {"pass"}


def test_check_selection(run):
    result = run.check(tags=["presence"]).collect()
    assert len(result) == 21
    assert {row["check_name"] for row in result} == {"not_null"}


def test_raw_schema_drift(spark, paths, tmp_path):
    text = open(paths.feeds["copilot_billing"]).read().splitlines()
    changed = tmp_path / "seats.csv"
    changed.write_text("\n".join([text[0] + ",surprise", *[line + ",x" for line in text[1:]]]))
    feeds = dict(paths.feeds, copilot_billing=str(changed))
    found = build(spark, type(paths)(feeds), provider="copilot").schema_failures()
    assert [name for name, _ in found] == ["copilot_billing"]
    assert "surprise" in found[0][1]


def test_key_drift_of_the_json_feeds(spark, paths, run, tmp_path):
    assert run.key_drift().collect() == []
    page = json.loads(open(paths.feeds["anthropic_usage"]).readline())
    page["data"][0]["results"][0]["cache_creation"]["ephemeral_24h_input_tokens"] = 7
    changed = tmp_path / "usage.json"
    changed.write_text(json.dumps([page, page], indent=1))
    feeds = dict(paths.feeds, anthropic_usage=str(changed))
    found = build(spark, type(paths)(feeds), provider="anthropic").key_drift().collect()
    assert [tuple(r) for r in found] == [
        ("anthropic_usage", "cache_creation", "ephemeral_24h_input_tokens", 2)
    ]


def test_generic_feeds_must_fit_their_dataset(spark, paths, tmp_path):
    feed = tmp_path / "commitments.csv"
    feed.write_text("contract_id,cost\na,1\nb,2\n")
    wrong = type(paths)(paths.feeds, {"contract_commitment": str(feed)})
    with pytest.raises(ValueError, match="contract_commitment"):
        build(spark, wrong, provider="azure_ai")
    feed.write_text("ContractId,cost\na,1\nb,2\n")
    half = build(spark, wrong, provider="azure_ai")
    assert half.canonical["ContractCommitment"].count() == 2
    assert [name for name, reason in half.schema_failures() if "cost" in reason] == ["contract_commitment"]
    assert ("contract_commitment", "ContractCommitmentCost") in half.missing_columns()


def test_missing_columns_and_unknown_providers(spark, paths, run):
    assert ("aws_cur", "line_item/UsageAmount") not in run.missing_columns()
    with pytest.raises(ValueError, match="azure"):
        build(spark, paths, enabled=["aws_cur", "azure"])


def test_written_run_reads_its_own_tables(spark, paths, run, rows, tmp_path):
    written = run.write(str(tmp_path / "out"))
    for frame in (*written.staged.values(), *written.mapped.values(), *written.canonical.values()):
        files = frame.inputFiles()
        assert all("/out/" in f or "/out_staged/" in f for f in files)
    again = [row.asDict() for row in written.canonical["CostAndUsage"].collect()]
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert sorted(map(str, written.check().collect())) == sorted(map(str, run.check().collect()))
    month = read_partitioned(spark, str(tmp_path / "out"), ["aws_cur"], months=["2031-05"])
    assert month.count() == 5


def test_empty_selection_gives_an_empty_report(run):
    assert run.check(tags=["nosuch"]).collect() == []
    assert run.check(tags=["nosuch"]).columns == run.check(tags=["presence"]).columns
    assert run.asserts_chosen(["schema"]) and not run.asserts_chosen(["presence"])
    assert not run.asserts_chosen(severity="warn")


def test_freshness_of_the_run(run):
    found = {r["feed"]: r["status"] for r in run.freshness().collect()}
    assert found["aws_cur"] == "pass" and len(found) == len(run.staged)


def test_strict_is_the_default(spark, paths, tmp_path):
    cost = tmp_path / "cost.json"
    page = json.loads(open(paths.feeds["anthropic_cost"]).readline())
    more = dict(page["data"][0]["results"][0], cost_type="manual", amount="900")
    page["data"][0]["results"].append(more)
    cost.write_text(json.dumps(page) + "\n")
    changed = type(paths)(dict(paths.feeds, anthropic_cost=str(cost)))
    billed = {
        strict: build(spark, changed, enabled=["anthropic"], strict=strict)
        .canonical["CostAndUsage"]
        .agg(F.sum("BilledCost"))
        .head()[0]
        for strict in (True, False)
    }
    assert billed[True] > billed[False]
    default = build(spark, changed, enabled=["anthropic"]).canonical["CostAndUsage"]
    assert default.agg(F.sum("BilledCost")).head()[0] == pytest.approx(billed[True])


def test_views(spark, run):
    run.publish()
    total = spark.sql("select sum(BilledCost) from CostAndUsage where _provider = 'azure_ai'")
    assert total.head()[0] == 4.0
    assert spark.table("stg_aws_cur").count() == 5


def test_reconciled_bills_the_whole_staged_cost(spark, paths):
    run = build(spark, paths, enabled=["anthropic"], strict="reconciled")
    staged = run.staged["anthropic_cost"].selectExpr("sum(amount_usd)").first()[0]
    billed = run.canonical["CostAndUsage"].selectExpr("sum(BilledCost)", "count_if(ChargeCategory = 'Adjustment')").first()
    assert abs(billed[0] - staged) < 1e-9 and billed[1] == 2  # one model without usage, in both hours
    less = build(spark, paths, enabled=["anthropic"]).canonical["CostAndUsage"].selectExpr("sum(BilledCost)").first()[0]
    assert less < staged
