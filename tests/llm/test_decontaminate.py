from __future__ import annotations

import random
import re

from tallyloom.llm.decontaminate import find_items


def shingles(text, width=5):
    w = words_of(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def words_of(text):
    return [x for x in re.split(r"[\x20\x09-\x0d]+", (text or "").lower()) if x]


def expected(docs, items):
    out = set()
    for i, text in docs:
        held = {w: shingles(text, w) for w in range(1, 6)}
        for k, item in items:
            width = min(5, len(words_of(item))) or 5
            want = shingles(item, width)
            held_now = held[width]
            if want and len(held_now & want) >= 0.8 * len(want):
                out.add((i, k, len(held_now & want), len(want)))
    return out


def got(df):
    rows = [(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_same_as_brute_force(spark, documents, words):
    draw = random.Random(4)
    items = [(k, words(draw.randrange(5, 90), 1000 + k)) for k in range(60)]
    items += [(80, "too short"), (81, None), (82, ""), (83, "a a a a a a a a"), (84, items[0][1]), (None, words(30, 7))]
    docs = []
    for i in range(200):
        _, item = items[draw.randrange(60)]
        w = item.split()
        for _ in range(draw.randrange(0, 4)):  # some just above the threshold, some just below
            w[draw.randrange(len(w))] = "other"
        docs.append((i, f"{words(draw.randrange(0, 40), i)}\n{' '.join(w).upper()}\t{words(30, 300 + i)}"))
    docs += [(300, None), (301, ""), (302, "a a a a a"), (303, words(20_000, 1) + " " + items[3][1] + " " + words(9, 2))]
    docs += [(304, items[5][1]), (304, items[5][1]), (304, items[6][1]), (305, words(30, 7)), (None, items[7][1])]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as phrases", "1 as k")
    found = find_items(spark, documents(docs, extra=True), table)
    assert got(found) == expected(docs, items)


def test_short_items(spark, documents, words):
    items = [(1, "Capital of  France"), (2, "yes"), (3, "a b"), (4, "b a"), (5, "one two three four"), (6, words(9, 1)), (7, " ")]
    docs = [(1, "the capital of france is"), (2, "Yes: a b a\tone two three five"), (3, "ONE two\nthree four"), (4, words(20, 1)), (5, "yes"), (6, "")]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert got(find_items(spark, documents(docs), table)) == expected(docs, items)
    assert {r.doc_id for r in find_items(spark, documents(docs), table.where("item_id = 1")).collect()} == {1}


def test_hot_item(spark, documents, words):
    items = [(1, words(30, 1))]
    docs = [(i, f"{words(10, 50 + i)} {items[0][1]}") for i in range(300)]
    found = find_items(spark, documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == expected(docs, items)


def test_beyond_the_broadcast_threshold(spark, documents, words):
    items = [(k, words(20, k)) for k in range(10)]
    docs = [(i, words(20, i) + " tail") for i in range(20)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = find_items(spark, documents(docs), spark.createDataFrame(items, "item_id long, text string"))
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert got(found) == expected(docs, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([], "item_id long, text string")
    assert find_items(spark, documents([(1, "a b c d e f")]), items).collect() == []
    assert find_items(spark, documents([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).collect() == []
