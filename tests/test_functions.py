"""Text predicates and column helpers, the predicates next to another engine's parsers."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

from tallyloom.functions import (
    cast_text,
    concat_present,
    exact_sum,
    guarded_ratio,
    is_castable,
    is_date_time,
    is_decimal,
    is_json,
    is_key_value,
    literal,
    month_end,
    plus_month_less_day,
    quoted,
    utc_instant,
    utc_timestamp,
)


def evaluate(spark, values, sql, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").selectExpr(f"{sql} as x").collect()]


# Accepted forms of a date-time, and texts near them.
DATE_TIMES = [
    "2025-01-02", "2025-1-2", "25-1-2", "5-1-2", "2025-01-02 ", "  2025-01-02", "12025-01-02",
    "-2025-01-02", "0000-01-01", "2025-13-01", "2025-02-30", "2024-02-29", "2025-00-10", "20250102",
    "2025-001-02", "2025-01-002", "2025/01/02", "", "soon",
    "2025-01-02T00:00:00", "2025-01-02T00:00:00Z", "2025-01-02T00:00:00z", "2025-01-02T00:00:00 Z",
    "2025-01-02T00:00:00+02", "2025-01-02T00:00:00+02:00", "2025-01-02T00:00:00-0530",
    "2025-01-02T00:00:00+2", "2025-01-02T00:00:00+020", "2025-01-02T00:00:00+2:00",
    "2025-01-02T00:00:00+99:00", "2025-01-02T00:00:00+02:00:30", "2025-01-02T00:00:00+",
    "2025-01-02T00:00:00.5Z", "2025-02-30T00:00:00Z", "2025-01-02TT00:00:00Z",
    "2025-01-02 1:2:3", "2025-01-02  01:02:03", "2025-01-02\t01:02:03", "2025-01-02 01:02",
    "2025-01-02 24:00:00", "2025-01-02 23:60:00", "2025-01-02 23:59:60", "2025-01-02 23:59:59.1",
    "2025-01-02 001:02:03", "2025-01-02 01:02:03Z", "2025-01-02T00:00:00UTC",
]


def test_date_time_text(spark):
    con = duckdb.connect()
    forms = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S%z")
    want = [
        any(con.execute("select try_strptime($1, $2)", [v, f]).fetchone()[0] for f in forms)
        for v in DATE_TIMES
    ]
    assert dict(zip(DATE_TIMES, evaluate(spark, DATE_TIMES, is_date_time("v")))) == dict(
        zip(DATE_TIMES, want)
    )


JSON_TEXTS = [
    '{"a":1}', '{"a":{"b":[1,2]}}', "[1]", "[]", "{}", "1", "-1.5e3", '"x"', '"]"', "true", "null",
    ' {"a":1} ', "\n[1]\n", '{"a":"é\\n"}', '{"":1}',
    "", " ", "[1,2", "1,2", "1 2", "1],[2", "1]", "1}", "],[", "}", "[", '{"a":1}x', '1,"w":2',
    "[1]//c", "[1],[2]", '{"v":1},{"v":2}', "{a:1}", "tru", "truex", "01", "+1", ".5", "-", '"a" "b"',
]


def test_json_text(spark):
    con = duckdb.connect()
    want = {
        v: con.execute("select try_cast($1 as json) is not null", [v]).fetchone()[0]
        for v in JSON_TEXTS
    }
    assert dict(zip(JSON_TEXTS, evaluate(spark, JSON_TEXTS, is_json("v")))) == want


def test_key_value_text(spark):
    values = ["a:b", "A_1:2", "a:b:c", "a :b", ":b", "a:", "a:b\n", "a-b:c"]
    assert evaluate(spark, values, is_key_value("v")) == [True, True] + [False] * 6


def test_decimal_text(spark):
    good = ["1", "-1.5", "1e5", ".5", "1.", " 7 ", "NaN", "inf", "12345678901234567890123"]
    bad = ["", "abc", "1,000", "1d", "1.0f", "--1", "1 2"]
    assert evaluate(spark, good + bad, is_decimal("v")) == [True] * len(good) + [False] * len(bad)


def test_null_text_is_neither_good_nor_bad(spark):
    for predicate in (is_date_time, is_json, is_key_value, is_decimal):
        assert evaluate(spark, [None], predicate("v")) == [None]
    for kind in ("double", "bigint", "date", "timestamp", "string"):
        assert evaluate(spark, [None], is_castable("v", kind)) == [None]


def test_castable_agrees_with_cast(spark):
    for kind, good, bad in (
        ("bigint", ["1", "1.5", "-2.5", "1e3"], ["x", "1e30", ""]),
        ("double", ["1", "1e400"], ["x", "1d"]),
        ("date", ["2025-01-31"], ["2025-02-30", "x"]),
        ("timestamp", ["2025-01-02T03:04:05Z", "2025-01-02"], ["2025-01-02T25:00:00Z", "x"]),
    ):
        assert evaluate(spark, good + bad, is_castable("v", kind)) == (
            [True] * len(good) + [False] * len(bad)
        )
        assert None not in evaluate(spark, good, cast_text("v", kind))


def test_whole_numbers_round_half_away(spark):
    values = ["1.4", "1.5", "2.5", "-2.5", "1e5", " 7 ", None, "9223372036854775807"]
    want = [1, 2, 3, -3, 100000, 7, None, 9223372036854775807]
    assert evaluate(spark, values, cast_text("v", "bigint")) == want


def test_unreadable_text_raises(spark):
    for kind in ("bigint", "double", "date", "timestamp"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            evaluate(spark, ["soon"], cast_text("v", kind))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_become_utc_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = [
            "2025-01-02T00:00:00Z",
            "2025-01-02T00:00:00+02:00",
            "2025-01-02T00:00:00-0530",
            "2025-01-02",
            "2025-03-09 02:30:00",
            "2025-01-02T03:04:05.123456Z",
        ]
        assert evaluate(spark, values, utc_timestamp("v")) == [
            dt.datetime(2025, 1, 2),
            dt.datetime(2025, 1, 1, 22),
            dt.datetime(2025, 1, 2, 5, 30),
            dt.datetime(2025, 1, 2),
            dt.datetime(2025, 3, 9, 2, 30),
            dt.datetime(2025, 1, 2, 3, 4, 5, 123456),
        ]
        moment = utc_instant("timestamp_micros(1735787045123456)")
        assert evaluate(spark, ["x"], moment) == [dt.datetime(2025, 1, 2, 3, 4, 5, 123456)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ratio_needs_a_quantity(spark):
    df = spark.createDataFrame([(6.0, 3), (6.0, 0), (None, 3), (0.0, 2)], "a double, q int")
    got = [row[0] for row in df.selectExpr(guarded_ratio("a", "q")).collect()]
    assert got == [2.0, None, None, 0.0]


def test_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e8, 0.0000000001, -1e8] * 50
    frames = [spark.createDataFrame([(v,) for v in vs], "v double").repartition(n)
              for vs, n in ((values, 1), (sorted(values), 7), (values[::-1], 3))]
    sums = {df.selectExpr(exact_sum("v")).head()[0] for df in frames}
    assert sums == {30.000000005}


def test_sum_keeps_small_and_large_amounts(spark):
    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        return df.selectExpr(exact_sum("v")).head()[0]

    assert total([4e-11] * 1000) == pytest.approx(4e-8, rel=1e-15)
    assert total([1e18, 1.0, -1e18]) == 1.0
    assert total([1e25, 2.5]) == 1e25
    assert total([1e-30, 1e-30]) == 2e-30
    assert total([9e19] * 300) == pytest.approx(2.7e22)
    assert total([None, None]) is None and total([None, 2.0]) == 2.0
    assert math.isnan(total([1.0, math.nan])) and total([math.inf, 1.0]) == math.inf


def test_json_beyond_the_parsers_limits_is_not_judged(spark):
    long, deep, wide = '"' + "x" * 21_000_000 + '"', "[" * 1200 + "]" * 1200, "1" * 1200
    assert evaluate(spark, [long, deep, wide], is_json("v")) == [None, None, None]
    fits = ["[" * 900 + "]" * 900, '"' + "x" * 1_000_000 + '"', "[" * 90 + "]" * 89, "1" * 900 + "x"]
    assert evaluate(spark, fits, is_json("v")) == [True, True, False, False]


def test_named_zones_are_applied(spark):
    values = [
        "2025-07-01T12:00:00 Europe/Paris",
        "2025-07-01 12:00:00 PST",
        "2025-07-01T12:00:00[Asia/Tokyo]",
        "2025-07-01T12:00:00 UTC",
        "2025-07-01T12:00:00GMT+5",
    ]
    castable = evaluate(spark, values, is_castable("v", "timestamp"))
    hours = {0: 10, 1: 19, 3: 12, 4: 7}
    for i, value in enumerate(values):
        if castable[i]:
            got = evaluate(spark, [value], cast_text("v", "timestamp"))[0]
            assert got == dt.datetime(2025, 7, 1, hours[i])
        else:
            with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
                evaluate(spark, [value], cast_text("v", "timestamp"))
    assert castable[0] and castable[3]


def test_concat_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, 1), (None, None, None)], "x string, y string, z int")
    assert [r[0] for r in df.selectExpr(concat_present("x", "y", "z")).collect()] == ["a1", ""]


def test_month_arithmetic_clips(spark):
    values = ["2024-01-31", "2024-02-01", "2023-12-15", None]
    end = evaluate(spark, values, month_end("cast(v as date)"))
    term = evaluate(spark, values, plus_month_less_day("cast(v as date)"))
    assert end == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2023, 12, 31), None]
    assert term == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 1, 14), None]


def test_literals_and_names_survive_odd_characters(spark):
    for value in ("it's", 'say "x"', "back\\slash", "line\nbreak", "`tick`", "", "%_"):
        assert spark.range(1).selectExpr(f"{literal(value)} as x").head()[0] == value
        df = spark.createDataFrame([(1,)], "a int").withColumnRenamed("a", value or "b")
        assert df.selectExpr(f"{quoted(value or 'b')} as x").head()[0] == 1
    for value in (1, 1.5, True, None, 1e-9):
        assert spark.range(1).selectExpr(f"{literal(value)} as x").head()[0] == value
