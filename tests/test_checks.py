"""Each check on rows made to break it, the fused report, and the split."""

from __future__ import annotations

import datetime as dt

import pytest

from tallyloom.model import CURRENCY_CODES, Manifest
from tallyloom.operators import drift
from tallyloom.operators.checks import Check, violations
from tallyloom.operators.report import (
    quarantine,
    read_quarantine,
    report,
    select_checks,
    write_quarantine,
)
from tallyloom.plans import nested_ai
from tallyloom.plans.suites import cost_and_usage_suite, provider_suite, staging_suite

DAY = dt.datetime(2025, 1, 2)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1, "k:v", '{"a":1}', "2025-01-02", 2.0, 3.0, 6.0, "USD", DAY, "x", "x"),
            (2, "k v", "{a", "01/02/2025", 2.0, 3.0, 7.0, "usd", DAY.replace(microsecond=5), "x", "y"),
            (3, None, None, None, None, None, None, None, None, None, "z"),
        ],
        "id int, tag string, js string, day string, a double, b double, c double, cur string,"
        " ts timestamp_ntz, s string, t string",
    )


@pytest.mark.parametrize(
    ("kind", "column", "params", "broken"),
    [
        ("type_string", "tag", {}, []),
        ("type_string", "a", {}, [1, 2]),
        ("type_decimal", "a", {}, []),
        ("type_decimal", "id", {}, []),
        ("type_decimal", "tag", {}, [1, 2]),
        ("type_datetime", "ts", {}, []),
        ("type_datetime", "day", {}, [1, 2]),
        ("type_json", "js", {}, []),
        ("type_json", "a", {}, [1, 2]),
        ("format_string", "a", {}, [1, 2]),
        ("format_numeric", "tag", {}, [1, 2]),
        ("format_currency", "cur", {}, []),
        ("format_unit", "a", {}, [1, 2]),
        ("format_datetime", "day", {}, [2]),
        ("format_datetime", "ts", {}, [2]),
        ("format_key_value", "tag", {}, [2]),
        ("format_json", "js", {}, [2]),
        ("regex_match", "tag", {"pattern": "^k[:]"}, [2]),
        ("regex_match", "tag", {"pattern": "v"}, []),
        ("national_currency", "cur", {"values": CURRENCY_CODES}, [2]),
        ("accepted_values", "cur", {"values": ("usd",)}, [1]),
        ("greater_or_equal", "c", {"threshold": 7}, [1]),
        ("less_or_equal", "c", {"threshold": 6.5}, [2]),
        ("decimal_value", "day", {}, [1, 2]),
        ("decimal_value", "a", {}, []),
        ("castable", "day", {"to": "date"}, [2]),
        ("column_equality", "s", {"other": "t"}, [2]),
        ("multiplication_equals", "a", {"factor": "b", "result": "c", "tolerance": 0.5}, [2]),
        ("string_ends_with", "tag", {"value": ":v"}, [2]),
        ("not_null", "tag", {}, [3]),
        ("column_comparison", "a", {"other": "b", "comparator": ">"}, [1, 2]),
        ("column_comparison", "a", {"other": "b", "comparator": "<"}, []),
        ("column_comparison", "a", {"other": "a", "comparator": ">="}, []),
        ("column_comparison", "c", {"other": "b", "comparator": "<="}, [1, 2]),
        ("column_comparison", "s", {"other": "t", "comparator": "=="}, [2]),
        ("column_comparison", "s", {"other": "t", "comparator": "!="}, [1]),
        ("column_comparison", "s", {"other": "t", "comparator": "==", "legacy": True}, [1]),
        ("column_comparison", "s", {"other": "t", "comparator": "!=", "legacy": True}, [2]),
    ],
)
def test_check(rows, kind, column, params, broken):
    check = Check(kind, column, params=params)
    found = violations(rows, check, keep=("id",))
    assert sorted(row["id"] for row in found.collect()) == broken
    counted = report(rows, [check]).head()
    assert counted["violations"] == len(broken)
    assert counted["status"] == ("error" if broken else "pass")


def test_unknown_names_are_refused(rows):
    with pytest.raises(ValueError, match="unknown check"):
        Check("bogus", "tag")
    with pytest.raises(ValueError, match="unknown comparator"):
        violations(rows, Check("column_comparison", "a", params={"other": "b", "comparator": "~"}))


def test_distinct_count_is_global(rows):
    two = Check("distinct_count", "tag", params={"other": "cur", "expected": 2})
    assert violations(rows, two).collect() == []
    one = Check("distinct_count", "tag", "warn", params={"other": "cur", "expected": 1})
    assert [row[0] for row in violations(rows, one).collect()] == [2]
    got = {row["violations"]: row["status"] for row in report(rows, [two, one]).collect()}
    assert got == {0: "pass", 1: "warn"}


def test_report_is_one_scan(rows):
    checks = [Check("not_null", "tag"), Check("format_json", "js"), Check("type_string", "s")]
    plan = report(rows, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_suite_shape():
    suite = cost_and_usage_suite()
    assert len(suite) == 100
    severities = [check.severity for check in suite]
    assert (severities.count("error"), severities.count("warn")) == (56, 44)
    kinds = [check.kind for check in suite]
    counts = {kind: kinds.count(kind) for kind in set(kinds)}
    assert counts == {
        "type_string": 44,
        "type_decimal": 9,
        "type_datetime": 4,
        "type_json": 3,
        "format_string": 1,
        "format_numeric": 5,
        "format_datetime": 4,
        "format_currency": 2,
        "format_unit": 1,
        "format_key_value": 2,
        "format_json": 3,
        "national_currency": 1,
        "not_null": 21,
    }
    assert sum(len(provider_suite(p)) for p in ("anthropic", "copilot", "azure_ai", "aws_cur")) == 12
    assert [check.column for check in staging_suite("aws_cur")] == ["UsageAccountId", "UsageAmount"]


def test_selection():
    suite = cost_and_usage_suite()
    assert len(select_checks(suite, tags=["presence"])) == 21
    assert {c.kind for c in select_checks(suite, tags=["conditional", "format"])} == {
        "format_currency",
        "format_key_value",
        "format_json",
    }
    assert len(select_checks(suite, columns=["BillingCurrency"], severity="error")) == 4


def test_split_is_whole(spark, rows, tmp_path):
    checks = [
        Check("not_null", "tag"),
        Check("format_json", "js"),
        Check("national_currency", "cur", params={"values": CURRENCY_CODES}),
        Check("not_null", "s", "warn"),
    ]
    good, held = quarantine(rows, checks)
    assert [row["id"] for row in good.collect()] == [1]
    assert good.columns == rows.columns
    reasons = {row["id"]: row["_failed"] for row in held.collect()}
    assert reasons == {2: ["format_json:js", "national_currency:cur"], 3: ["not_null:tag"]}
    path = str(tmp_path / "split")
    write_quarantine(rows, checks, path)
    assert [row["id"] for row in read_quarantine(spark, path, held=False).collect()] == [1]
    assert {row["id"] for row in read_quarantine(spark, path, held=True).collect()} == {2, 3}


def test_column_drift(rows):
    known = Manifest(frozenset(rows.columns) - {"t", "js"}, frozenset(["js"]))
    assert drift.unexpected_columns(rows, known) == ["t"]
    found = drift.schema_failures(rows, known).collect()
    assert [(r["column_name"], r["rows_with_value"]) for r in found] == [("t", 3)]
    assert found[0]["failure_reason"].startswith("UNEXPECTED COLUMN: t")
    assert drift.missing_columns(rows, Manifest(frozenset(["id", "gone"]))) == ["gone"]
    whole = Manifest(frozenset(rows.columns))
    assert drift.schema_failures(rows, whole).collect() == []


def test_payload_drift(spark):
    df = spark.createDataFrame(
        [('{"a":1,"b":2}',), ('{"b":1,"b":2}',), ("not json",), (None,), ('{"c":{"d":1}}',)], "p string"
    )
    found = drift.payload_key_drift(df, "p", Manifest(frozenset(["a"])))
    assert {row["key"]: row["rows_with_key"] for row in found.collect()} == {
        "b": 2,
        "c": 1,
        drift.UNREADABLE: 1,
    }


def test_page_drift(spark):
    lines = [
        '{"data":[{"starting_at":"x","zone":1,"results":[{"model":"m","new":1},{"new":2}]}],"more":1}',
        '{"data":[{"results":[]},{"zone":2,"results":null}],"has_more":false}',
        '{"data":null}',
        '{"data":[{"results":[{"cache_creation":{"ephemeral_24h_input_tokens":1},'
        '"server_tool_use":{"web_search_requests":1,"code_exec":2}}, {"cache_creation":null}]}]}',
        '{"data":[{"results":["x"]}, 7]}',
        '{"data":[',
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    found = {(r["level"], r["key"]): r["objects"] for r in nested_ai.raw_key_drift(df, "usage").collect()}
    assert found == {("page", "more"): 1, ("bucket", "zone"): 2, ("result", "new"): 2,
        ("cache_creation", "ephemeral_24h_input_tokens"): 1, ("server_tool_use", "code_exec"): 1,
        ("result", drift.UNREADABLE): 1, ("bucket", drift.UNREADABLE): 1, ("page", drift.UNREADABLE): 1,
    }


def test_an_empty_manifest_knows_nothing(spark):
    assert drift.manifest_frame(spark, Manifest()).count() == 0
    df = spark.createDataFrame([('{"a":1}',)], "p string")
    assert drift.payload_key_drift(df, "p", Manifest()).head()["key"] == "a"


def test_a_report_without_checks_is_empty(spark):
    found = report(spark.range(3), [])
    assert found.collect() == []
    assert found.columns == report(spark.range(3), [Check("not_null", "id")]).columns
