from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import set_join
from tallyloom.llm.set_join import candidates, classes


def shingle_set(text, width=4):
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def expected(rows):
    """Plain Python over rows (doc_id, text), every pair compared: sorted (doc_id, n_shingles, component_id)."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 85 * (len(a) + len(sets[j]) - common):
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = least.get(top(i))
        least[top(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return sorted(
        (repr(d), len(s), repr(least[top(i)] if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))
    )


def got(df):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in df.collect())


def changed(text, every, offset, draw):
    words = text.split()
    for i in range(offset, len(words), every):
        words[i] = f"x{draw.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    """Copies, chains of near copies, texts around the threshold, shared passages, short and odd texts."""
    draw = random.Random(11)
    rows = []

    def add(text):
        rows.append((len(rows) * 7 % 1009, text))

    def text(n):
        return " ".join(f"v{draw.randrange(3000)}" for _ in range(n))

    passage = text(60)
    for _ in range(12):
        base = text(draw.choice([5, 20, 80, 150]))
        add(base)
        for k in range(8):
            add(changed(base, draw.choice([30, 45, 60, 90]), k, draw))
        add(base + " " + passage)
        add(base.upper())
    for _ in range(25):
        add(text(draw.choice([6, 10, 15])) + " " + passage)
    chain = text(100).split()
    for k in range(12):
        add(" ".join(chain[k * 4 :] + [f"y{i}" for i in range(k * 4)]))
    template = text(120)
    for k in range(20):
        add(changed(template, 24, k, draw))
    for odd in ("", None, "  \t", "one", "ONE", "one two three", "a b c d", "a b c d", "É é", "é É"):
        add(odd)
    return rows


def test_same_as_every_pair(spark, documents, corpus):
    assert got(classes(spark, documents(corpus))) == expected(corpus)


@pytest.mark.parametrize("most, share", [(1, 1.0), (3, 0.05)])
def test_matches_and_share_do_not_change_classes(spark, documents, corpus, most, share):
    assert got(classes(spark, documents(corpus), most=most, share=share)) == expected(corpus)


def test_null_and_repeated_ids(spark, documents, words):
    a, b, c = words(40, 1), words(40, 2), words(40, 3)
    rows = [(None, a), (None, a), (5, a + " z"), (5, b), (5, b), (2, b), (None, c), (None, c + " z"), (9, None), (9, "")]
    assert got(classes(spark, documents(rows, extra=True))) == expected(rows)


def test_no_rows(spark, documents):
    assert classes(spark, documents([(1, "a")]).limit(0)).collect() == []


def test_very_long_texts(spark, documents, words):
    long = words(60_000, 4)
    rows = [(1, long), (2, long + " end"), (3, words(60_000, 5)), (4, long[: len(long) // 2])]
    assert got(classes(spark, documents(rows))) == expected(rows)


def test_a_class_of_copies_is_joined_in_linear_steps(spark, documents, words, monkeypatch):
    seen = []
    plain = set_join._linked
    monkeypatch.setattr(set_join, "_linked", lambda p, s: seen.append(p.count()) or plain(p, s))
    draw = random.Random(2)
    base = words(300, 6)
    rows = [(i, changed(base, 299, i, draw)) for i in range(150)]
    assert got(classes(spark, documents(rows))) == expected(rows)
    assert sum(seen) < 150 * 20 < 150 * 149 / 2


def listed(spark, sets):
    """Sets of numbers as ``candidates`` takes them, each with a label of its own."""
    rows = [(node, len(s), node, token) for node, s in enumerate(sets) for token in s]
    each = spark.createDataFrame(rows, "node long, n int, label long, s long")
    held = each.groupBy("s").agg(F.count("*").alias("held")).where("held > 1")
    return set_join._ordered(each, held).cache()


def linked_pairs(sets):
    return {
        (a, b)
        for a, x in enumerate(sets)
        for b, y in enumerate(sets)
        if a < b and 100 * len(x & y) >= 85 * len(x | y)
    }


@pytest.mark.parametrize("most", [1, 2, 6])
def test_no_pair_at_the_threshold_is_lost(spark, most):
    draw = random.Random(most)
    sets = {frozenset(draw.sample(range(24), draw.randrange(1, 24))) for _ in range(150)}
    sets |= {frozenset(draw.sample(range(9), draw.randrange(1, 9))) for _ in range(60)}
    sets |= {frozenset(range(100 + i, 200 + 2 * i)) for i in range(40)}
    sets = sorted(sets, key=sorted)
    found = {tuple(sorted(r)) for r in candidates(listed(spark, sets), most).collect()}
    assert linked_pairs(sets) and linked_pairs(sets) <= found


def test_prefixes_ask_for_more_matches_where_that_is_cheaper(spark):
    """Texts of two passages each: one match makes a candidate of all that share a passage, more do not."""
    draw = random.Random(4)
    passages = [[100 * p + k for k in range(40)] for p in range(8)]
    sets = []
    for i in range(120):
        a, b = draw.sample(range(8), 2)
        sets.append(frozenset(passages[a][: draw.choice([36, 38, 40])] + passages[b][draw.choice([0, 3]) :] + [10_000 + i % 4]))
    sets = sorted(set(sets), key=sorted)
    rare = listed(spark, sets)
    asked, lists = set_join._prefixes(rare, 6)
    assert {r.matches for r in set_join.with_matches(asked, lists, 6, verify=100.0).collect()} - {1}
    found = [{tuple(sorted(r)) for r in candidates(rare, most).collect()} for most in (1, 6)]
    assert all(linked_pairs(sets) <= f for f in found)


def test_texts_of_one_template_below_the_threshold_do_not_all_meet(spark):
    draw = random.Random(8)
    base = list(range(150))
    sets = []
    for i in range(300):
        kept = set(base) - {(p + k) % 150 for p in draw.sample(range(150), 5) for k in range(4)}
        sets.append(frozenset(kept | {1000 * (i + 1) + k for k in range(len(base) - len(kept))}))
    found = {tuple(sorted(r)) for r in candidates(listed(spark, sets), 6).collect()}
    assert linked_pairs(sets) <= found
    assert len(found) < len(sets) < len(sets) * (len(sets) - 1) / 2 / 100


def family(draw, members, outside):
    """Texts with up to two changed words, which link with their base, and with three, which miss it by little."""
    base = [f"b{i}" for i in range(150)]
    texts = []
    for i in range(members + outside):
        text = list(base)
        for k, at in enumerate(draw.sample(range(4, 146), i % 3 if i < members else 3)):
            text[at] = f"x{i}" if k else f"y{i % 40}"
        texts.append(" ".join(text + ["z"] * (i % 2)))
    return [(i, t) for i, t in enumerate(texts)]


def test_a_family_at_the_threshold_does_not_meet_in_full(spark, documents, monkeypatch):
    rows = family(random.Random(5), 140, 60)
    met, found = [], []
    around, pairs = set_join.around_pivots, set_join.candidates
    monkeypatch.setattr(set_join, "around_pivots", lambda apart: met.append(around(apart).count()) or around(apart))

    def searched(rare, most, without):
        found.append(pairs(rare, most, without).count())
        return pairs(rare, most, without)

    monkeypatch.setattr(set_join, "candidates", searched)
    assert got(classes(spark, documents(rows))) == expected(rows)
    assert met and sum(met) + sum(found) < len(rows)


def test_pivots_lose_no_link(spark, documents, corpus, monkeypatch):
    monkeypatch.setattr(set_join, "LONG_LIST", 1)
    assert got(classes(spark, documents(corpus))) == expected(corpus)


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_around_a_pivot_and_links_with_it_are_all(spark, seed):
    """Any pivot will do: nodes that link are in one component by links with the pivot and pairs around it."""
    draw = random.Random(seed)
    base = set(range(40))
    sets = {frozenset(base)}
    for i in range(150):
        more = {draw.choice([100 + k % 7, 1000 + i * 9 + k]) for k in range(draw.randrange(7))}
        sets.add(frozenset(base - set(draw.sample(range(40), draw.randrange(9))) | more))
    sets = sorted(sets, key=sorted)
    rows = [(p, i, i, len(s), len(sets[p]), len(s ^ sets[p]), list(s ^ sets[p])) for p in (0, len(sets) // 2) for i, s in enumerate(sets)]
    ddl = "pivot long, node long, label long, n int, pivot_n int, d int, apart array<long>"
    apart = spark.createDataFrame(rows, ddl).cache()
    for p in (0, len(sets) // 2):
        mine = apart.where(f"pivot = {p}")
        direct = {tuple(sorted(r)) for r in set_join.near_pivots(mine).collect()}
        assert direct == {(a, b) for a, b in linked_pairs(sets) if p in (a, b)}
        pairs = {tuple(r) for r in set_join.around_pivots(mine).collect()}
        inside = {p} | {a + b - p for a, b in direct}
        want = {(a, b) for a, b in linked_pairs(sets) if not {a, b} <= inside}
        assert want and want <= pairs
