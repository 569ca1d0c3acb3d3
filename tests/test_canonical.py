"""Newest-row selection, cost matching, and the plans behind them."""

from __future__ import annotations

import datetime as dt

import pytest

from tallyloom.model import column_list
from tallyloom.operators.canonical import (
    Branch,
    MappedFeed,
    canonical_all,
    canonical_one,
    dedup_latest,
    dedup_report,
    duplicates,
)
from tallyloom.operators.mapping import Constant, Expression
from tallyloom.plans import nested_ai

T0 = dt.datetime(2025, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark):
    rows = [
        # account, service, amount, day, load hour
        ("a", "s", 1.0, 1, 1),
        ("a", "s", 2.0, 1, 3),
        ("a", "s", 3.0, 1, 2),
        ("a", "s", 9.0, 2, 1),
        (None, "s", 4.0, 1, 1),
        (None, "s", 5.0, 1, 1),
        ("b", None, 6.0, 1, None),
        ("b", None, 7.0, 1, 0),
    ]
    return spark.createDataFrame(
        [(a, s, x, T0.replace(day=d), None if h is None else T0.replace(hour=h)) for a, s, x, d, h in rows],
        "account string, service string, amount double, day timestamp_ntz, _loaded_at timestamp_ntz",
    )


RULES = {
    "BilledCost": "amount",
    "ListCost": "amount",
    "SubAccountId": "account",
    "ServiceName": "service",
    "ChargePeriodStart": "day",
    "ChargeDescription": Constant("fixed"),
    "ContractedCost": Expression("amount + 1"),
}


@pytest.fixture(scope="module")
def feed(staged):
    return MappedFeed("p", (Branch(staged, RULES),))


def test_newest_row_wins(feed):
    got = feed.latest()
    assert got.columns == [*column_list("CostAndUsage"), "_loaded_at"]
    # the latest load; a tie goes to the lower cost; no load time loses to any
    assert sorted(row["BilledCost"] for row in got.collect()) == [2.0, 4.0, 7.0, 9.0]
    row = next(row for row in got.collect() if row["BilledCost"] == 2.0)
    assert (row["ListCost"], row["ContractedCost"], row["ChargeDescription"]) == (2.0, 3.0, "fixed")


def test_narrow_and_wide_agree(feed):
    wide = dedup_latest(canonical_one(feed)).drop("_provider")
    assert sorted(map(str, wide.collect())) == sorted(map(str, feed.latest().collect()))


def test_result_does_not_depend_on_partitioning(staged):
    results = set()
    for partitions in (1, 3, 8):
        frame = staged.repartition(partitions).orderBy("amount", ascending=partitions == 3)
        rows = MappedFeed("p", (Branch(frame, RULES),)).latest().collect()
        results.add(tuple(sorted(map(str, rows))))
    assert len(results) == 1


def test_branches_are_reduced_together(staged):
    other = {**RULES, "BilledCost": Expression("amount + 100"), "ChargeDescription": Constant("fixed")}
    both = MappedFeed("p", (Branch(staged, RULES), Branch(staged, other)))
    assert both.frame().count() == 16
    assert both.latest().count() == 4
    different = {**RULES, "ChargeDescription": Constant("other")}
    assert MappedFeed("p", (Branch(staged, RULES), Branch(staged, different))).latest().count() == 8


def test_custom_key(feed):
    assert feed.latest(key=["SubAccountId"]).count() == 3
    assert feed.latest(key=["ChargeDescription"]).count() == 1


def test_duplicates_are_reported(feed):
    report = dedup_report(canonical_one(feed)).head().asDict()
    assert report == {"_provider": "p", "rows": 8, "kept": 4, "dropped": 4}
    # what goes are the costs 1, 3, 5 and 6
    assert duplicates([feed]).head().asDict() == {**report, "billed": 37.0, "billed_kept": 22.0}


def test_unknown_names_are_refused(feed, staged):
    for key in (["ChargePeriodStrt"], ["ChargePeriodStart", "ResourceID"]):
        with pytest.raises(ValueError, match=key[-1]):
            feed.latest(key=key)
    with pytest.raises(ValueError, match="azure"):
        canonical_all([feed], enabled=["p", "azure"])
    with pytest.raises(ValueError, match="nosuch"):
        dedup_latest(staged, key=["nosuch"])


def test_provider_selection(staged, feed):
    other = MappedFeed("q", (Branch(staged, RULES),))
    assert canonical_all([feed, other]).count() == 8
    assert {r["_provider"] for r in canonical_all([feed, other], enabled=["q"]).collect()} == {"q"}
    with pytest.raises(ValueError, match="unknown providers: z"):
        canonical_all([feed], enabled=["z"])
    with pytest.raises(ValueError, match="no provider"):
        canonical_all([feed], enabled=[])


def test_hot_key_is_cut_before_the_shuffle(feed):
    plan = plan_of(feed.latest())
    assert plan.count("Exchange") == 1
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before
    # constants and repeated columns are not shuffled
    assert "BillingCurrency" not in before and "ListCost" not in before


def usage(spark, rows):
    return spark.createDataFrame(
        [(T0, T0.replace(hour=end), m, w, n, n, n, n, n, n, "t", "k", T0) for end, m, w, n in rows],
        "bucket_start timestamp_ntz, bucket_end timestamp_ntz, model string, workspace_id string,"
        " uncached_input_tokens bigint, cache_read_input_tokens bigint, output_tokens bigint,"
        " cache_creation_1h_tokens bigint, cache_creation_5m_tokens bigint,"
        " web_search_requests bigint, service_tier string, api_key_id string,"
        " _loaded_at timestamp_ntz",
    )


def cost(spark, rows):
    return spark.createDataFrame(
        [(T0, T0.replace(hour=1), *row) for row in rows],
        "bucket_start timestamp_ntz, bucket_end timestamp_ntz, model string, workspace_id string,"
        " token_type string, cost_type string, amount_usd double",
    )


def priced(spark, usage_rows, cost_rows, strict=False):
    got = nested_ai.priced_meters(usage(spark, usage_rows), cost(spark, cost_rows), strict)
    return sorted(
        (row["workspace_id"] or "-", row["token_slot"], row["quantity"], row["amount_usd"])
        for row in got.collect()
        if row["amount_usd"] is not None
    )


def test_cost_matches_on_token_type_or_cost_type(spark):
    usage_rows = [(1, "m", "w", 10), (1, "m", None, 5), (1, None, "w", 3)]
    cost_rows = [
        ("m", "w", "output_tokens", "tokens", 1.0),
        ("m", None, "output_tokens", "tokens", 2.0),
        ("m", "w", None, "web_search", 4.0),
        # pays for a token meter and, being of that cost type, for searches
        ("m", None, "uncached_input_tokens", "web_search", 8.0),
        ("m", "w", "cache_creation.ephemeral_5m_input_tokens", None, 16.0),
        ("m", "w", None, "tokens", 32.0),
        ("m", "x", "output_tokens", "tokens", 64.0),
        (None, "w", "output_tokens", "tokens", 128.0),
        ("m", "w", "fee", "tokens", 256.0),
    ]
    assert priced(spark, usage_rows, cost_rows) == [
        ("-", "output_tokens", 5, 2.0),
        ("-", "uncached_input_tokens", 5, 8.0),
        ("-", "web_search_requests", 5, 8.0),
        ("w", "cache_creation_5m_tokens", 10, 16.0),
        ("w", "output_tokens", 10, 1.0),
        ("w", "web_search_requests", 10, 4.0),
    ]


def test_two_cost_types_double_the_row_unless_strict(spark):
    cost_rows = [
        ("m", "w", "output_tokens", "tokens", 1.0),
        ("m", "w", "output_tokens", "manual", 2.0),
    ]
    loose = priced(spark, [(1, "m", "w", 10)], cost_rows)
    assert [row[3] for row in loose] == [1.0, 2.0]
    assert priced(spark, [(1, "m", "w", 10)], cost_rows, strict=True) == [
        ("w", "output_tokens", 10, 3.0)
    ]


def test_every_meter_row_survives_the_join(spark):
    got = nested_ai.priced_meters(usage(spark, [(1, "m", "w", 10), (2, None, None, 0)]), cost(spark, []))
    assert got.count() == 6


def test_join_has_no_nested_loop(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(nested_ai.priced_meters(usage(spark, [(1, "m", "w", 1)]), cost(spark, [])))
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_lists_are_distinct_and_sorted(spark):
    base = usage(spark, [(1, "m", "w", 1)] * 3).drop("service_tier", "api_key_id")
    rows = base.selectExpr(
        "*", "if(monotonically_increasing_id() % 2 = 0, 'b', 'a') as service_tier",
        "cast(null as string) as api_key_id",
    )
    got = nested_ai.usage_totals_with_lists(rows.union(rows)).head()
    assert got["output_tokens"] == 6
    assert got["service_tiers"] == sorted(got["service_tiers"])
    assert got["api_key_ids"] == []
