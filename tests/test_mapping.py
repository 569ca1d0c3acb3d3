"""Column rules, conforming, and the shape of the canonical datasets."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from tallyloom.model import CURRENCY_CODES, column_list, dataset_schema, declared_type, empty_dataset
from tallyloom.operators import mapping as m


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(
        [("a", 1.5, None, "2025-01-02T00:00:00+01:00"), (None, None, "x", None)],
        "`sec/name` string, cost double, note string, at string",
    )


def test_each_rule(feed):
    rules = {
        "plain": "sec/name",
        "renamed": m.Rename("cost"),
        "cast": m.Cast("cost", "string"),
        "or_zero": m.Coalesce("cost", 0.0),
        "or_other": m.Coalesce("sec/name", m.Rename("note")),
        "sql": m.Expression("cost * 2"),
        "text": m.Constant("it's"),
        "number": m.Constant("2.5", "double"),
        "joined": m.Concat(("`sec/name`", "'-'", "note")),
    }
    df = m.rename_map(feed, rules)
    assert df.columns == list(rules)
    first, second = df.collect()
    assert tuple(first) == ("a", 1.5, "1.5", 1.5, "a", 3.0, "it's", 2.5, "a-")
    assert tuple(second) == (None, None, None, 0.0, "x", None, "it's", 2.5, "-x")


def test_mapping_fills_the_dataset(feed):
    df = m.apply_mapping(feed, {"BilledCost": "cost"}, "CostAndUsage", {"_extra": "note"})
    assert df.columns == [*column_list("CostAndUsage"), "_extra"]
    for field in dataset_schema("CostAndUsage"):
        assert df.schema[field.name].dataType == field.dataType
    row = df.head()
    assert row["BilledCost"] == 1.5
    assert {row[name] for name in column_list("CostAndUsage") if name != "BilledCost"} == {None}


def test_rule_for_an_unknown_column(feed):
    with pytest.raises(ValueError, match="Bogus"):
        m.apply_mapping(feed, {"Bogus": "cost"}, "CostAndUsage")


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame(
        [("2025-01-02T00:00:00+01:00", "1.5", "x")],
        "InvoiceIssueDate string, BilledCost string, unrelated string",
    )
    got = m.conform(df, "InvoiceDetail", keep=["unrelated"])
    assert got.columns == [*column_list("InvoiceDetail"), "unrelated"]
    row = got.head()
    assert row["InvoiceIssueDate"] == dt.datetime(2025, 1, 1, 23)
    assert (row["BilledCost"], row["InvoiceId"]) == (1.5, None)


def test_dataset_shapes(spark):
    widths = {"CostAndUsage": 62, "BillingPeriod": 6, "InvoiceDetail": 22, "ContractCommitment": 30}
    for name, width in widths.items():
        assert len(set(column_list(name))) == width
        empty = empty_dataset(spark, name)
        assert (empty.count(), empty.schema) == (0, dataset_schema(name))
    assert column_list("Unknown") == []
    assert len(set(CURRENCY_CODES)) == 180


def test_declared_types():
    assert declared_type("ListCost") == T.DoubleType()
    assert declared_type("PaymentDueDate") == T.TimestampNTZType()
    assert declared_type("ContractCommitmentCost") == T.DoubleType()
    assert declared_type("Tags") == T.StringType()
    assert declared_type("elsewhere", T.LongType()) == T.LongType()
    assert declared_type("elsewhere") == T.StringType()
