from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import divergence
from tallyloom.llm.divergence import UNIT, audit, column_runs, run_sum, shares, terms_of

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def expected(rows, least=10, top=10):
    """Plain Python over rows (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    docs = [(lang, source, re.findall(TERM, text.translate(lower))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        held = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= least)
        uses = {}
        for name, source, terms in docs:
            if name == lang:
                uses.setdefault(source, Counter()).update(t for t in terms if t in set(kept))
        whole = sum(uses.values(), Counter())

        def share(counts, kept=kept):
            size = sum(counts.values()) + 2 * len(kept)
            return {t: 1 + UNIT * (counts[t] + 2) // size for t in kept}

        p = {source: share(counts) for source, counts in uses.items()}
        q = share(whole)
        for source in uses:
            pairs = [
                (-sum((p[source][t] - p[o][t]) ** 2 // (p[source][t] + p[o][t]) for t in kept), o.encode())
                for o in uses
                if o != source
            ]
            terms = [
                (-((p[source][t] - q[t]) ** 2 // (p[source][t] + q[t])), t.encode())
                for t in kept
                if uses[source][t] and p[source][t] > q[t]
            ]
            out |= {(lang, source, "pair", i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(pairs))}
            out |= {(lang, source, "term", i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(terms)[:top])}
    return out


def made(spark, rows):
    full = [(i, r[2], r[0], r[1], "x", "y") for i, r in enumerate(rows)]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, source string, term string, place string"
    ).repartition(5)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    words = [f"w{c}{d}" for c in "abcdefghij" for d in "xyzé"] + ["Ünder", "ÀB"]
    out = []
    for i in range(160):
        lang = draw.choice(["en", "fr", None, "rare"]) if i < 150 else "rare"
        text = " ".join(draw.choice(words[: 5 + i % 40]) for _ in range(draw.choice([0, 1, 9, 60])))
        out.append((lang, draw.choice(["a", "b", "c", None, "Z", "é"]), text.title() if i % 3 else text))
    out += [("en", "none", None), ("en", "empty", ""), ("xx", "alone", "one two"), ("en", "a", "9 _ -")]
    return out + out[:7]  # repeated rows count again


def test_terms():
    assert terms_of("It's A_B2c Straße ÀÉ\x00d\x85e".encode()) == [
        t.encode() for t in ("it", "s", "a", "b", "c", "straße", "ÀÉ", "d\x85e")
    ]


def test_same_as_plain_python(spark, rows):
    found = [tuple(r) for r in audit(spark, made(spark, rows)).collect()]
    assert len(found) == len(set(found)) and set(found) == expected(rows)


def test_blocks_and_tiles_do_not_change_a_value(spark, rows, monkeypatch):
    many = [(lang, f"{source}{i % 13}", text) for i, (lang, source, text) in enumerate(rows)]
    monkeypatch.setattr(divergence, "TILE_SOURCES", 4)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    monkeypatch.setattr(divergence, "HELD_COUNTS", 20)
    found = {tuple(r) for r in audit(spark, made(spark, many), 4).collect()}
    assert found == expected(many, 4)


def test_nothing_kept_and_no_rows(spark):
    few = [("en", "a", "one"), ("en", "b", "two"), ("de", "a", None)]
    found = {tuple(r) for r in audit(spark, made(spark, few)).collect()}
    assert found == expected(few) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}
    assert audit(spark, made(spark, few).limit(0)).collect() == []


def test_very_long_text(spark):
    long = " ".join(f"t{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(300_000))
    some = [("en", "s", long)] + [("en", f"s{i}", long[: 500 * i]) for i in range(12)]
    assert {tuple(r) for r in audit(spark, made(spark, some)).collect()} == expected(some)


def test_shares_are_exact_for_large_counts():
    counts, whole = [0, 1, 10**12, 9 * 10**14], 9 * 10**15
    assert shares(np.array(counts), whole).tolist() == [1 + UNIT * (c + 2) // whole for c in counts]


def test_runs_give_the_columns_back():
    draw = np.random.default_rng(3)
    columns = draw.choice([0, 0, 0, 1, 1, 2], size=(4, 50))
    place, term = np.nonzero(columns)
    back = np.zeros_like(columns)
    for p, starts, ends, counts in column_runs(place, term, columns[place, term]):
        for s, e, c in zip(starts, ends, counts, strict=True):
            back[p, s:e] = c
        assert all(a != b or x < y for a, b, x, y in zip(counts, counts[1:], ends, starts[1:], strict=False))
    assert (back == columns).all()
    runs = {p: (s, e, c) for p, s, e, c in column_runs(place, term, columns[place, term])}
    want = sum((a - b) ** 2 // (a + b) if a + b else 0 for a, b in zip(columns[0] + 5, columns[1] + 5, strict=True))
    one, two = ((s, e, c + 5) for s, e, c in (runs[0], runs[1]))
    assert run_sum(one, two, 5, 5, 50) == want
