from __future__ import annotations

import random

import numpy as np

from tallyloom.llm import arrays as a
from tallyloom.llm.components import components
from tallyloom.llm.near_dedup import near_duplicates, signatures


def shingles(text):
    w = (text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows, threshold=0.8):
    up = {r[0]: r[0] for r in rows if r[0] is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    known = [(i, text or "", shingles(text)) for i, text in rows if i is not None]
    for n, (i, text, held) in enumerate(known):
        for j, other, more in known[:n]:
            both = len(held | more)
            if text == other or (both and len(held & more) >= threshold * both):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in up}


def got(df):
    return {r.doc_id: r.class_id for r in df.collect() if r.doc_id is not None}


def edited(text, places, seed):
    w = text.split()
    for p in places:
        w[p] = f"edit{seed}x{p}"
    return " ".join(w)


def test_same_as_brute_force(spark, documents, words):
    base = words(200, 1)
    rows = [(i, words(60, 100 + i)) for i in range(20)]
    rows += [(30 + i, edited(base, [10 * i + 5], i)) for i in range(6)]
    rows += [(50, base), (51, base), (52, None), (53, ""), (54, "one two"), (55, "one two"), (56, "one")]
    rows += [(57, "that " * 300), (58, "that " * 299 + "this"), (59, base), (59, base), (60, " ")]
    df = near_duplicates(spark, documents([*rows, (None, base)], extra=True))
    assert got(df) == expected(rows)
    assert df.count() == len(rows) + 1
    assert df.where("doc_id is null and class_id is not null").isEmpty()


def test_cloud_of_copies_around_an_absent_text(spark, documents, words):
    """Copies near the threshold: many pairs just below it, some above, and no centre that has them all."""
    draw = random.Random(5)
    base = words(150, 3)
    rows = [
        (i, edited(base, sorted(draw.sample(range(5, 145), draw.choice([2, 3, 4]))), draw.randrange(3)))
        for i in range(150)
    ]
    draw.shuffle(rows)
    assert got(near_duplicates(spark, documents(rows, parts=5))) == expected(rows)


def test_common_passage_does_not_join(spark, documents, words):
    passage = words(40, 1)
    rows = [(i, f"{passage} {words(20, 10 + i)}") for i in range(60)]
    rows += [(100 + i, f"{words(20, 10 + i)} {passage}") for i in range(3)]
    assert got(near_duplicates(spark, documents(rows))) == expected(rows)


def test_repeated_phrases_do_not_hide_a_copy(spark, documents, words):
    """Shingles of one side many times over: the sets stay alike, the weights don't."""
    rows = []
    for i in range(8):
        base, phrase = words(204, 50 + i), words(5, 500 + i)
        rows += [(10 * i, base), (10 * i + 1, f"{base} {' '.join([phrase] * 200)}")]
        rows += [(10 * i + 2, f"{base} {' '.join([phrase] * 50)} {words(3, 900 + i)}")]
    want = expected(rows)
    assert len(set(want.values())) == 8
    assert got(near_duplicates(spark, documents(rows))) == want


def test_empty_table(spark, documents):
    assert near_duplicates(spark, documents([])).collect() == []


def test_registers_agree_with_probability_jaccard():
    names = a.mix(np.arange(300, dtype=np.uint64), 3)
    one, other = np.arange(0, 200), np.arange(60, 300)
    weight = np.ones(300)
    weight[100:150] = 4
    hashes = np.concatenate((names[one], names[other]))
    owner = np.concatenate((np.zeros(len(one), int), np.ones(len(other), int)))
    weights = np.concatenate((weight[one], weight[other] * 2))
    chosen = signatures(hashes, owner, weights, 2, 4000)
    x, y = np.zeros(300), np.zeros(300)
    x[one], y[other] = weight[one], weight[other] * 2
    both = np.flatnonzero((x > 0) & (y > 0))
    want = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in both)
    assert abs((chosen[0] == chosen[1]).mean() - want) < 0.04


def test_components(spark):
    edges = spark.createDataFrame(
        [(i, i + 1) for i in range(1, 40)] + [(100, 50), (100, 60), (60, 100), (7, 7)], "one long, two long"
    )
    found = {r.node: r.label for r in components(spark, edges).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50, 100: 50}
    assert components(spark, edges.limit(0)).collect() == []
