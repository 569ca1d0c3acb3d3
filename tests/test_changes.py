"""Feeds that change: widening types, reconciled sides, deliveries that repeat, drifting types, many distincts."""

from __future__ import annotations

import datetime as dt
import glob
import os
import uuid

import pytest
from conftest import cost_result, usage_result
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.canonical import dedup_latest
from tallyloom.operators.checks import Check
from tallyloom.operators.distincts import distinct_counts, distinct_report, is_far
from tallyloom.operators.members import member_bitmaps, member_counts, numbered, united
from tallyloom.operators.type_drift import type_drift
from tallyloom.plans import nested_ai, reconcile
from tallyloom.sources import ledger, read_csv, read_parquet, upsert
from tallyloom.sources.widening import disagree, parquet_files, schema_runs, wider


@pytest.fixture
def folder(scratch):
    return f"{scratch}/{uuid.uuid4().hex}"


def kind(ddl):
    return T.StructType.fromDDL(f"x {ddl}")["x"].dataType


@pytest.mark.parametrize(
    "one, two, want",
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("int", "double", "double"),
        ("float", "bigint", "double"),
        ("decimal(10, 2)", "int", "decimal(12,2)"),
        ("decimal(38, 2)", "decimal(30, 10)", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("boolean", "int", "int"),
        ("string", "bigint", "string"),
        ("boolean", "date", "string"),
        ("struct<a: int>", "string", "string"),
        ("struct<a: int, b: date>", "struct<b: timestamp_ntz, c: int>", "struct<a:int,b:timestamp_ntz,c:int>"),
        ("array<int>", "array<double>", "array<double>"),
        ("map<string, int>", "map<string, bigint>", "map<string,bigint>"),
    ],
)
def test_least_type_of_two(spark, one, two, want):
    assert wider(kind(one), kind(two)).simpleString() == want
    assert wider(kind(two), kind(one)).simpleString().count(",") == want.count(",")
    assert wider(kind(one), T.NullType()) == wider(T.NullType(), kind(one)) == kind(one)


def test_files_of_changing_types(spark, folder):
    parts = [
        "select 1 as id, cast(7 as int) as n, date'2024-01-02' as day, named_struct('a', 1) as s, map('k', 1) as m",
        "select 2 as id, 8000000000 as n, timestamp_ntz'2024-01-02 03:00:00' as day, named_struct('a', 2L, 'b', 'x') as s, map('k', 2.5D) as m",
        "select 3 as id, 'many' as n, cast(null as date) as day, named_struct('b', 'y') as s, map('k', 1) as m",
    ]
    for i, sql in enumerate(parts):
        spark.sql(sql).write.mode("append").parquet(folder)
        for path in glob.glob(f"{folder}/*.parquet"):
            if os.path.getmtime(path) > 1e9:  # not yet dated
                os.utime(path, (1000 + i, 1000 + i))
    with pytest.raises(Exception) as caught:
        spark.read.option("mergeSchema", True).parquet(folder)
    assert disagree(caught.value)
    rows = {r.id: r for r in read_parquet(spark, folder).collect()}
    assert [rows[i].n for i in (1, 2, 3)] == ["7", "8000000000", "many"]
    assert [rows[i].day for i in (1, 2, 3)] == [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 3), None]
    assert [tuple(rows[i].s) for i in (1, 2, 3)] == [(1, None), (2, "x"), (None, "y")]
    assert [rows[i].m["k"] for i in (1, 2, 3)] == [1.0, 2.5, 1.0]


def test_runs_follow_the_order_of_writing_and_keep_folder_columns(spark, folder):
    for i, value in enumerate(["cast(1 as int)", "cast(2 as int)", "3L", "4L", "cast(5 as int)"]):
        path = f"{folder}/month=2024-0{i + 1}"
        spark.sql(f"select {value} as v").write.parquet(path)
        for file in glob.glob(f"{path}/*.parquet"):
            os.utime(file, (1000 + i, 1000 + i))
    df = read_parquet(spark, folder)
    assert df.schema["v"].dataType == T.LongType()
    assert sorted((r.v, r.month) for r in df.collect()) == [(i, f"2024-0{i}") for i in range(1, 6)]
    runs = schema_runs(spark, parquet_files(spark, folder), folder)
    assert [len(files) for files, _ in runs] == [2, 2, 1]
    both = read_parquet(spark, [f"{folder}/month=2024-01", f"{folder}/month=2024-03"])
    assert sorted(r.v for r in both.collect()) == [1, 3]


# Reconciliation.

HOUR = "2024-01-01T0{}:00:00Z"


def pages(spark, shape, buckets):
    rows = [
        (False, None, [{"starting_at": HOUR.format(start), "ending_at": HOUR.format(end), "results": results}])
        for start, end, results in buckets
    ]
    return spark.createDataFrame(rows, shape).withColumn("_loaded_at", F.expr("timestamp_ntz'2024-01-05 00:00:00'"))


def test_nothing_of_the_cost_is_lost_or_billed_twice(spark):
    usage = nested_ai.stage_usage(
        pages(
            spark,
            nested_ai.USAGE_PAGE,
            [
                (1, 2, [usage_result("m", None, (5, 0, 3, 0, 0, 1))]),
                (1, 3, [usage_result("m", None, (2, 0, 0, 0, 0, 0))]),  # the same start with another end
                (2, 3, [usage_result("m", "w", (0, 0, 4, 0, 0, 0)), usage_result(None, "w", (1, 0, 0, 0, 0, 0))]),
            ],
        )
    )
    cost = nested_ai.stage_cost(
        pages(
            spark,
            nested_ai.COST_PAGE,
            [
                (1, 2, [cost_result("m", None, "uncached_input_tokens", "300"), cost_result("m", None, None, "50", "web_search")]),
                (1, 2, [cost_result("m", None, "uncached_input_tokens", "10", "manual")]),
                (2, 3, [cost_result("m", "w", "uncached_input_tokens", "640"), cost_result("m", "w", None, "1", "manual")]),
                (2, 3, [cost_result(None, "w", "uncached_input_tokens", "7"), cost_result("m", "w", None, None)]),
                (5, 6, [cost_result("m", "w", "output_tokens", "0.5")]),
            ],
        )
    )
    feed = reconcile.map_reconciled(usage, cost)
    rows = [(r.ChargeCategory, r.ChargeDescription, r.BilledCost) for r in feed.frame().collect()]
    assert sorted(rows, key=str) == sorted(
        [
            ("Usage", "m - Uncached Input Tokens", 3.1),
            ("Usage", "m - Output Tokens", 0.0),
            ("Fee", "m - Web Search Requests", 0.5),
            ("Usage", "m - Output Tokens", 0.0),
            ("Usage", None, 0.0),
            ("Adjustment", "m - Cost without usage, token:uncached_input_tokens", 6.4),
            ("Adjustment", "m - Cost without usage, other:manual", 0.01),
            ("Adjustment", " - Cost without usage, token:uncached_input_tokens", 0.07),
            ("Adjustment", "m - Cost without usage, token:output_tokens", 0.005),
        ],
        key=str,
    )
    assert feed.latest().count() == len(rows)  # each is a charge of its own
    found = {r.bucket_start.hour: r for r in reconcile.balance(usage, cost).collect()}
    assert {h: (r.staged, r.billed, r.adjusted, r.difference) for h, r in found.items()} == {
        1: (3.6, 3.6, 0.0, 0.0),
        2: (6.48, 0.0, 6.48, 0.0),
        5: (0.005, 0.0, 0.005, 0.0),
    }
    assert (found[2].costs_without_usage, found[2].meters_without_cost) == (3, 2)


def test_one_side_alone(spark):
    usage = nested_ai.stage_usage(pages(spark, nested_ai.USAGE_PAGE, [(1, 2, [usage_result("m", None, (1, 0, 0, 0, 0, 0))])]))
    cost = nested_ai.stage_cost(pages(spark, nested_ai.COST_PAGE, [(1, 2, [cost_result("m", None, "output_tokens", "9")])]))
    for u, c, outcome in ((usage.limit(0), cost, "cost only"), (usage, cost.limit(0), "usage only")):
        assert [r.outcome for r in reconcile.reconcile(u, c).collect()] == [outcome]
    assert reconcile.balance(usage.limit(0), cost.limit(0)).collect() == []


# Upsert.


def charges(spark, rows):
    """(provider, month, key, loaded day, value)."""
    full = [(p, m, k, dt.datetime(2024, 5, day), v) for p, m, k, day, v in rows]
    return spark.createDataFrame(full, "_provider string, _month string, k string, _loaded_at timestamp_ntz, v int")


KEY = ("_provider", "_month", "k")


def stored(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).selectExpr("_provider", "cast(_month as string)", "k", "v").collect()), key=str)


def test_deliveries_in_any_order_give_the_same_table(spark, folder):
    rows = [
        ("a", "2024-01", "x", 1, 1),
        ("a", "2024-01", "x", 3, 3),
        ("a", "2024-01", "y", 2, 4),
        ("a", "2024-02", "x", 2, 5),
        ("b", None, "x", 1, 6),
        (None, "2024-01", "x", 1, 7),
        ("b'\\", "2024-01", "x", 1, 8),
        ("a", "2024-01", "x", 2, 2),
    ]
    want = sorted(
        map(tuple, dedup_latest(charges(spark, rows), KEY).select("_provider", "_month", "k", "v").collect()), key=str
    )
    for turn, cut in enumerate(([0, 3, 8], [0, 5, 6, 8, 8], [0, 8])):
        path = f"{folder}/{turn}"
        for low, high in zip(cut, cut[1:], strict=False):
            upsert.upsert_latest(spark, charges(spark, rows[low:high]), path, KEY)
        upsert.upsert_latest(spark, charges(spark, rows[2:6]), path, KEY)  # again
        assert stored(spark, path) == want


def test_only_touched_folders_are_rewritten(spark, folder):
    upsert.upsert_latest(spark, charges(spark, [("a", "2024-01", "x", 1, 1), ("a", "2024-02", "x", 1, 2)]), folder, KEY)
    before = set(glob.glob(f"{folder}/*/*/*.parquet"))
    touched = upsert.upsert_latest(spark, charges(spark, [("a", "2024-02", "z", 1, 3)]), folder, KEY)
    after = set(glob.glob(f"{folder}/*/*/*.parquet"))
    assert touched == [("a", "2024-02")]
    assert {p for p in before if "2024-01" in p} == {p for p in after if "2024-01" in p}
    assert upsert.upsert_latest(spark, charges(spark, []), folder, KEY) == []
    assert stored(spark, folder) == [("a", "2024-01", "x", 1), ("a", "2024-02", "x", 2), ("a", "2024-02", "z", 3)]


def test_a_lost_run_is_finished_by_the_next(spark, folder, monkeypatch):
    upsert.upsert_latest(spark, charges(spark, [("a", "2024-01", "x", 1, 1), ("b", "2024-01", "x", 1, 2)]), folder, KEY)
    plain = upsert.finish
    calls = []

    def lost(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        return plain(*args)

    monkeypatch.setattr(upsert, "finish", lost)
    with pytest.raises(RuntimeError):
        upsert.upsert_latest(spark, charges(spark, [("a", "2024-01", "x", 2, 9)]), folder, KEY)
    assert stored(spark, folder)[0][3] == 1
    upsert.upsert_latest(spark, charges(spark, [("b", "2024-01", "y", 2, 5)]), folder, KEY)
    assert [r[3] for r in stored(spark, folder)] == [9, 2, 5]


def test_new_columns(spark, folder):
    upsert.upsert_latest(spark, charges(spark, [("a", "2024-01", "x", 1, 1)]), folder, KEY)
    more = charges(spark, [("a", "2024-01", "y", 1, 2)]).withColumn("extra", F.lit("new"))
    upsert.upsert_latest(spark, more, folder, KEY)
    def extras():
        rows = spark.read.option("mergeSchema", True).parquet(folder).collect()
        return sorted((r._month, r.k, r.extra or "") for r in rows)

    assert extras() == [("2024-01", "x", ""), ("2024-01", "y", "new")]
    # a delivery without the column to a folder that has it, beside one that doesn't
    upsert.upsert_latest(spark, charges(spark, [("a", "2024-02", "x", 1, 1)]), folder, KEY)
    upsert.upsert_latest(spark, charges(spark, [("a", "2024-01", "z", 1, 1), ("a", "2024-02", "z", 1, 1)]), folder, KEY)
    assert ("2024-01", "y", "new") in extras() and len(extras()) == 5


# Ledger.


def deliver(folder, name, lines):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}", "w") as out:
        out.write("a,b\n" + "".join(f"{line}\n" for line in lines))


def load(spark, folder):
    return ledger.ingest_new(spark, f"{folder}/in", read_csv, f"{folder}/table", f"{folder}/ledger")


def loaded(spark, folder):
    return sorted((r.a, r.b) for r in ledger.read_loaded(spark, f"{folder}/table", f"{folder}/ledger").collect())


def test_a_file_counts_once(spark, folder):
    deliver(folder, "one [1].csv", ["1,x", "2,y"])
    deliver(folder, "same.csv", ["2,y", "1,x"])  # the same rows in another order
    deliver(folder, "none.csv", [])
    assert load(spark, folder) == {"copy": 1, "loaded": 2}
    assert load(spark, folder) == {}
    assert loaded(spark, folder) == [("1", "x"), ("2", "y")]
    deliver(folder, "two.csv", ["3,z", "3,z"])
    deliver(folder, "late copy.csv", ["1,x", "2,y"])
    assert load(spark, folder) == {"copy": 1, "loaded": 1}
    assert loaded(spark, folder) == [("1", "x"), ("2", "y"), ("3", "z"), ("3", "z")]
    entries = ledger.read_ledger(spark, f"{folder}/ledger").collect()
    assert len(entries) == 5 and {e.turn for e in entries} == {1, 2}


def test_a_changed_file_replaces_its_rows(spark, folder):
    deliver(folder, "one.csv", ["1,x"])
    load(spark, folder)
    deliver(folder, "one.csv", ["1,x", "2,changed"])
    assert load(spark, folder) == {"loaded": 1}
    assert loaded(spark, folder) == [("1", "x"), ("2", "changed")]


def test_a_batch_without_entries_is_not_read(spark, folder, monkeypatch):
    deliver(folder, "one.csv", ["1,x"])
    load(spark, folder)
    deliver(folder, "two.csv", ["2,y"])
    plain = spark.createDataFrame

    def lost(rows, schema, *more):
        if schema == ledger.LEDGER and rows:
            raise RuntimeError("driver lost")
        return plain(rows, schema, *more)

    monkeypatch.setattr(spark, "createDataFrame", lost)
    with pytest.raises(RuntimeError):
        load(spark, folder)
    monkeypatch.undo()
    assert loaded(spark, folder) == [("1", "x")]
    assert load(spark, folder) == {"loaded": 1}
    assert loaded(spark, folder) == [("1", "x"), ("2", "y")]


# Type drift.


def test_types_that_differ_by_path(spark):
    shape = "n bigint, x double, t string, b boolean, o struct<a: bigint, l: array<string>>, m map<string, int>"
    docs = [
        '{"n": 1, "x": 2, "t": "s", "b": true, "o": {"a": 1, "l": ["p", null]}, "m": {"k": "any"}}',
        '{"n": "1", "x": "2", "t": 3, "b": 0, "o": [], "m": []}',
        '{"n": 1.5, "x": 2.5, "t": {"u": 1}, "o": {"a": {}, "l": [1, "p", 2]}}',
        '{"n": 99999999999999999999, "o": {"l": {"p": 1}}, "it\'s": 1}',
        '{"n": null, "x": null, "t": null, "o": null}',
        "[1]",
        "{not json",
        None,
    ]
    found = type_drift(spark.createDataFrame([(d,) for d in docs], "value string"), shape).collect()
    assert {(r.path, r.declared, r.found, r["values"], r.documents) for r in found} == {
        ("n", "bigint", "STRING", 1, 1),
        ("n", "bigint", "DECIMAL", 2, 2),
        ("x", "double", "STRING", 1, 1),
        ("t", "string", "BIGINT", 1, 1),
        ("t", "string", "OBJECT", 1, 1),
        ("b", "boolean", "BIGINT", 1, 1),
        ("o", "object", "ARRAY", 1, 1),
        ("o.a", "bigint", "OBJECT", 1, 1),
        ("o.l", "array", "OBJECT", 1, 1),
        ("o.l[]", "string", "BIGINT", 2, 1),
        ("m", "object", "ARRAY", 1, 1),
        ("$", "object", "ARRAY", 1, 1),
        ("$", "object", "(unreadable)", 1, 1),
    }


# Distinct counts.


def check(column, other, expected, severity="error"):
    return Check("distinct_count", column, severity, params={"other": other, "expected": expected})


def test_many_distinct_counts_in_one_pass(spark):
    rows = [(i % 7, float(i % 3) * (-1.0 if i % 2 else 1.0), None if i % 5 else "x", i) for i in range(210)]
    df = spark.createDataFrame(rows, "a int, b double, c string, d int").repartition(5)
    checks = [check("a", "b", 5), check("c", "a", 7), check("a", "c", 1), check("c", "d", 42, "warn"), check("a", "d", 1)]
    want = [
        df.where(f"{c.column} is not null").selectExpr(f"count(distinct {c.params['other']})").first()[0] for c in checks
    ]
    found = {r.check_no: r.distinct_count for r in distinct_counts(df, checks).collect()}
    assert [found[i] for i in range(5)] == want
    exact, gated = (
        {(r.column_name, r.other): r for r in distinct_report(df, checks, gate).collect()} for gate in (False, True)
    )
    keys = [(c.column, c.params["other"]) for c in checks]
    assert [exact[k].distinct_count for k in keys] == want
    assert [gated[k].distinct_count for k in keys] == [*want[:4], None]
    assert [gated[k].status for k in keys] == ["pass", "pass", "pass", "pass", "error"]
    assert distinct_report(df, []).collect() == []
    assert [r.distinct_count for r in distinct_report(df.limit(0), checks[:1], gate=False).collect()] == [0]


def test_far_and_near():
    assert is_far(100, 10) and is_far(10, 100) and is_far(5, 0)
    assert not is_far(100, 60) and not is_far(0, 0) and not is_far(1, 0) and not is_far(3, 2)


# Bitmaps of members.


def test_bitmaps_count_members_of_coarser_groups(spark):
    rows = [("g" if i % 3 else None, i % 4, None if i % 11 == 0 else f"m{i * 7 % 500}") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, h int, member string").repartition(6)
    numbers = numbered(spark, df, "member")
    assert numbers.count() == numbers.select("_number").distinct().count() == 500
    fine = member_bitmaps(df, numbers, ["g", "h"], "member")
    for group in (["g", "h"], ["g"]):
        want = df.groupBy(*group).agg(F.countDistinct("member").alias("n"))
        assert sorted(map(str, member_counts(fine, group, "n").collect())) == sorted(map(str, want.collect()))
    halves = [member_bitmaps(df.where(f"h % 2 = {i}"), numbers, ["g"], "member") for i in (0, 1)]
    both = united(halves[0].unionByName(halves[1]), ["g"])
    assert sorted(map(str, member_counts(both, ["g"], "n").collect())) == sorted(map(str, member_counts(fine, ["g"], "n").collect()))
