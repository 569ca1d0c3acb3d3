from __future__ import annotations

import random

from pyspark.sql import functions as F

from tallyloom.llm.revisits import canonical_url, resolve

SCHEMA = "record_id long, url string, time long, status int, headers map<string,string>, digest string"


def test_canonical_url(spark):
    same = {
        "http://WWW.Example.org:80/a/?utm_source=x&b=2&a=1#top": "example.org/a?a=1&b=2",
        "https://example.org/a?a=1&ref=q&b=2": "example.org/a?a=1&b=2",
        "https://example.org": "example.org",
        "https://example.org//": "example.org",
        "https://example.org/A?reference=1": "example.org/A?reference=1",
        "no url": "no url",
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in same], "url string")
    assert {r.url: r.c for r in df.withColumn("c", canonical_url(F.col("url"))).collect()} == same


def naive(rows):
    out = {}
    for i, url, time, status, headers, digest in rows:
        if status != 304:
            continue
        earlier = [r for r in rows if r[3] == 200 and r[1] == url and None not in (r[2], time) and r[2] < time]
        of = max(earlier, key=lambda r: (r[2], r[0]), default=None) if url is not None else None
        if of is None:
            out[i] = (None, "missing", None)
            continue
        mine, theirs = headers or {}, of[4] or {}
        checks = [
            x.removeprefix("W/") == y.removeprefix("W/")
            for x, y in ((mine.get(k), theirs.get(k)) for k in ("etag", "last-modified"))
            if x is not None and y is not None
        ]
        if not checks and digest is not None and of[5] is not None:
            checks = [digest == of[5]]
        outcome = "unverified" if not checks else "resolved" if checks[0] else "changed"
        merged = {**theirs, **{k: v for k, v in mine.items() if k in ("etag", "date", "last-modified") and v}}
        out[i] = (of[0], outcome, merged if outcome == "resolved" else None)
    return out


def test_same_as_naive(spark):
    draw = random.Random(2)
    rows = []
    for i in range(600):
        url = draw.choice(["https://h.org/hot"] * 4 + [f"https://h.org/{draw.randrange(20)}"])
        headers = {k: draw.choice(["1", "2"]) for k in ("etag", "last-modified", "date", "server") if draw.random() < 0.6}
        if "etag" in headers and draw.random() < 0.3:
            headers["etag"] = "W/" + headers["etag"]
        status = draw.choice([200, 304, 304])
        digest = draw.choice([None, "d1", "d2"])
        rows.append((i, url, draw.randrange(3_000_000), status, draw.choice([headers, headers, None]), digest))
    rows += [(700, None, 5, 304, {}, None), (701, "https://h.org/1", None, 304, {}, None), (702, "x", 1, 304, None, None)]
    rows += [(703, "https://h.org/1", None, 200, {}, "d"), (704, "https://h.org/hot", 9, 500, {}, "d")]
    rows += [(706, "https://h.org/t", 7, 200, {"etag": "1"}, "a"), (705, "https://h.org/t", 7, 200, {"etag": "2"}, "b")]
    rows += [(707, "https://h.org/t", 8, 304, {"etag": "1"}, None), (708, "https://h.org/t", 7, 304, {"etag": "1"}, None)]
    records = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as slice", "'y' as canonical", "2 as near")
    want = naive(rows)
    found = resolve(spark, records.repartition(5), slice_seconds=100_000).collect()
    assert {r.record_id: (r.response_id, r.outcome, r.headers) for r in found} == want
    assert len(found) == len(want)
    assert {r.outcome for r in found} == {"resolved", "changed", "unverified", "missing"}


def test_repeated_and_empty(spark):
    rows = [(1, "https://h.org/", 1, 200, {"etag": "1"}, "d")] * 2 + [(2, "https://h.org/", 2, 304, {"etag": "1"}, None)] * 2
    found = resolve(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.record_id, r.response_id, r.digest) for r in found] == [(2, 1, "d")] * 2
    assert resolve(spark, spark.createDataFrame([], SCHEMA)).collect() == []
