"""Stored reports, history, mergeable sketches and the feed as a stream."""

from __future__ import annotations

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import history
from tallyloom.operators.canonical import canonical_all, canonical_one, dedup_latest
from tallyloom.operators.checks import Check
from tallyloom.operators.history import as_of, changed_amounts, versions
from tallyloom.operators.report import report
from tallyloom.operators.sketches import column_sketches, described, measured_errors, merged_sketches
from tallyloom.operators.stored_report import kept_counts, report_changed
from tallyloom.plans import prefixed
from tallyloom.queries import changes, feeds
from tallyloom.sources import read_csv, with_load_time
from tallyloom.sources.upsert import folder_values
from tallyloom.streaming.ingest import feed_stream, ingest_stream


@pytest.fixture
def folder(scratch):
    return f"{scratch}/{uuid.uuid4().hex}"


# Stored reports.

CHECKS = [
    Check("not_null", "v", "error", ("a",)),
    Check("greater_or_equal", "v", "warn", ("a", "b"), {"threshold": 5}),
    Check("type_decimal", "v"),
    Check("distinct_count", "k", params={"other": "v", "expected": 3}),
]
FOLDERS = ("_provider", "_month")


def rows(spark, *values):
    return spark.createDataFrame(values, "_provider string, _month string, k string, v int")


def append(df, path):
    df.write.partitionBy(*FOLDERS).mode("append").parquet(path)


def same(found, want):
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_only_changed_folders_are_counted_again(spark, folder):
    path, kept = f"{folder}/table", f"{folder}/kept"
    append(rows(spark, ("a", "2024-01", "x", 1), ("a", "2024-02", "x", None), ("b/ c=d", None, "y", 7)), path)
    found, read = report_changed(spark, path, kept, CHECKS)
    assert len(read) == 3
    same(found, report(spark.read.parquet(path), CHECKS))
    found, read = report_changed(spark, path, kept, CHECKS)
    assert read == []
    append(rows(spark, ("a", "2024-02", "z", 2), ("c", "2024-02", "z", None)), path)
    found, read = report_changed(spark, path, kept, CHECKS)
    assert sorted(folder_values(name) for name in read) == [("a", "2024-02"), ("c", "2024-02")]
    same(found, report(spark.read.parquet(path), CHECKS))
    rows(spark, ("a", "2024-01", "x", 9)).write.partitionBy(*FOLDERS).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)
    found, read = report_changed(spark, path, kept, CHECKS)
    assert len(read) == 1
    same(found, report(spark.read.parquet(path), CHECKS))


def test_a_new_check_reads_all_and_a_known_one_nothing(spark, folder):
    path, kept = f"{folder}/table", f"{folder}/kept"
    append(rows(spark, ("a", "2024-01", "x", 1), ("b", "2024-01", "x", 8)), path)
    report_changed(spark, path, kept, CHECKS[:1])
    assert report_changed(spark, path, kept, CHECKS[:1])[1] == []
    other = Check("greater_or_equal", "v", params={"threshold": 2})
    found, read = report_changed(spark, path, kept, [CHECKS[0], other])
    assert len(read) == 2
    same(found, report(spark.read.parquet(path), [CHECKS[0], other]))
    report_changed(spark, path, f"{folder}/other", [])
    assert kept_counts(spark, f"{folder}/other").count() == 0


# History.


def shuffle_files(spark):
    """The shuffle files that the session's disk holds now."""
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in held.mkString("\n").split("\n") if "/shuffle_" in name}


def test_versions_in_parts(spark, scratch, monkeypatch):
    rows = [(f"k{i % 13}", None if i % 5 == 0 else 1 + i % 7, float(i * i % 17)) for i in range(120)]
    known = charges(spark, *rows, (None, 3, 7.0), (None, 6, 8.0), (None, None, 9.0))
    want = versions(known, ["k"])
    monkeypatch.setattr(history, "PARTS", 3)
    work, before = f"{scratch}/{uuid.uuid4().hex}", shuffle_files(spark)
    found = versions(known, ["k"], work, 1)
    assert not shuffle_files(spark) - before  # each part's went with it
    assert os.path.isdir(f"{work}/versions") and not [n for n in os.listdir(f"{work}/rows") if n.startswith(history.PART)]
    same(found, want)
    assert versions(known.limit(0), ["k"], f"{work}-none", 1).count() == 0


def test_few_rows_are_not_written(spark, scratch):
    work = f"{scratch}/{uuid.uuid4().hex}"
    assert versions(spark.range(3).selectExpr("id as k", "timestamp_ntz'2024-01-01 00:00:00' as _loaded_at"), ["k"], work).count() == 3
    assert not os.path.exists(work)


def test_the_report_in_parts_and_narrow(spark, monkeypatch):
    """The whole canonical rows, by shuffles of the columns that differ."""
    data = "/root/testdata/sf0.001"
    instants = [f"timestamp_ntz'{at} 00:00:00'" for at in ("1994-01-01", "1996-07-15", "2030-01-01")]
    feed = prefixed.map_report(prefixed.stage_report(feeds.report(spark, data)))
    want = as_of(versions(canonical_one(feed)), instants).drop("known_from", "known_to")
    monkeypatch.setattr(changes, "versions", lambda df, key, work: versions(df, key, work, 100_000))
    found = changes.charges_as_of(spark, data)
    assert found.dtypes == want.dtypes
    same(found, want)
    (path,) = {os.path.dirname(f.removeprefix("file://")) for f in found.inputFiles()}
    assert set(os.listdir(f"{path}/..")) == {"rows", "versions"}
    assert len(spark.read.parquet(path).columns) < 24 < len(found.columns)


def charges(spark, *values):
    full = [(k, None if day is None else dt.datetime(2024, 1, day), v) for k, day, v in values]
    return spark.createDataFrame(full, "k string, _loaded_at timestamp_ntz, BilledCost double").repartition(3)


def day(n):
    return f"timestamp_ntz'2024-01-{n:02d} 00:00:00'"


def test_what_was_known_when(spark):
    known = charges(
        spark, ("x", 2, 1.0), ("x", 5, 2.0), ("x", 5, 3.0), ("y", 4, 9.0), (None, 3, 7.0), (None, 6, 8.0), ("z", None, 4.0), ("z", 9, 5.0)
    )
    versioned = versions(known, ["k"])
    assert versioned.count() == 7  # of a load one row
    for n in range(1, 11):
        want = dedup_latest(known.where(f"_loaded_at <= {day(n)} or _loaded_at is null"), ["k"])
        same(as_of(versioned, [day(n)]).select("k", "BilledCost"), want.select("k", "BilledCost"))
    assert as_of(versioned, [day(1), day(20)]).count() == 1 + 4
    changed = changed_amounts(versioned, day(4), day(9), "BilledCost", ["k"]).collect()
    assert {(r.k, r.before, r.after) for r in changed} == {("x", 1.0, 2.0), (None, 7.0, 8.0), ("z", 4.0, 5.0)}


# Sketches.


def test_sketches_merge_and_keep_their_bounds(spark):
    draw = random.Random(3)
    values = [
        (i % 12, draw.gauss(0, 1) if i % 9 else None, f"t{min(draw.randrange(5000), draw.randrange(5000))}", i % 2 == 0, "long " * 100 + str(i % 3))
        for i in range(20_000)
    ]
    df = spark.createDataFrame(values, "month int, x double, t string, b boolean, l string").repartition(6)
    parts = column_sketches(df, ["month"])
    assert parts.count() == 12 * 4
    halves = [merged_sketches(parts.where(f"month % 2 = {i}")) for i in (0, 1)]
    whole = described(merged_sketches(halves[0].unionByName(halves[1])))
    found = {r.column_name: r for r in whole.collect()}
    assert {n: (r.rows, r.nulls) for n, r in found.items()} == {
        n: (20_000, df.where(f"{n} is null").count()) for n in ("x", "t", "b", "l")
    }
    for r in measured_errors(df, whole).collect():
        assert r.distinct_error <= 0.05 and (r.rank_error or 0) <= 0.025
    assert found["b"].distinct_estimate == 2 and found["l"].distinct_estimate == 3
    assert len(found["l"].frequent[0].item) < 250
    assert found["t"].at_quantiles is None and len(found["x"].at_quantiles) == 3


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(None, None)], "x double, t string")
    for frame, n in ((df, 1), (df.limit(0), 0)):
        found = {r.column_name: r for r in described(column_sketches(frame)).collect()}
        assert {c: (r.rows, r.nulls, r.distinct_estimate) for c, r in found.items()} == {c: (n, n, 0) for c in ("x", "t")}
        assert found["x"].at_quantiles is None and not found["t"].frequent


# Streaming.


def test_a_stream_gives_the_table_of_a_batch_run(spark, folder, paths):
    with open(paths.feeds["aws_cur"]) as file:
        header, *lines = file.read().splitlines()
    os.makedirs(f"{folder}/in")

    def deliver(name, some):
        with open(f"{folder}/in/{name}.csv", "w") as out:
            out.write("\n".join([header, *some]) + "\n")

    schema = read_csv(spark, paths.feeds["aws_cur"]).schema

    def run():
        raw = feed_stream(spark, f"{folder}/in", schema, files_at_once=1)
        make = lambda df: prefixed.map_report(prefixed.stage_report(df))
        ingest_stream(raw, make, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()

    deliver("one", lines[:3])
    deliver("two", lines[2:])  # one charge again
    run()
    before = sorted(os.listdir(f"{folder}/table"))
    run()
    assert sorted(os.listdir(f"{folder}/table")) == before
    deliver("three", lines[:1])
    run()
    batch = with_load_time(read_csv(spark, f"{folder}/in"))
    want = canonical_all([prefixed.map_report(prefixed.stage_report(batch))])
    found = spark.read.parquet(f"{folder}/table").select(*want.columns)
    keep = [c for c in want.columns if c != "_loaded_at"]
    assert sorted(map(str, found.select(keep).collect())) == sorted(map(str, want.select(keep).collect()))
    assert found.where(F.col("_loaded_at").isNull()).count() == 0
