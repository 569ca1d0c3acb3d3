from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from tallyloom.llm.quality import FEATURES, Model, classify, marginals


def text(draw, junk):
    lines = []
    for _ in range(draw.randrange(1, 12)):
        words = ["".join(draw.choices("abcdeé", k=draw.randrange(2, 9))) for _ in range(draw.randrange(4, 30))]
        if junk == "signs":
            words = [w + draw.choice(["%%%", "$$", "###"]) for w in words]
        elif junk == "same":
            words = [words[0]] * 20
        lines.append(" ".join(words).capitalize() + ".")
    return "\n".join(lines)


def test_marginals_same_as_enumeration():
    draw = np.random.default_rng(1)
    model = Model(np.zeros(1), draw.normal(size=(2, 2)), 0.3, np.zeros(1), np.ones(1), 0.5)
    good = draw.normal(size=6).tolist()
    weight = {}
    for path in itertools.product((0, 1), repeat=6):
        total = path[0] * model.first + sum(g for g, y in zip(good, path, strict=True) if y)
        total += sum(model.moves[x, y] for x, y in itertools.pairwise(path))
        weight[path] = np.exp(total)
    whole = sum(weight.values())
    want = [sum(w for p, w in weight.items() if p[i]) / whole for i in range(6)]
    assert marginals(good, model) == pytest.approx(want)


def test_held_out_documents(spark, documents):
    draw = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        junk = draw.choice([None, None, "signs", "same"])
        rows.append((i, text(draw, junk)))
        labels.append((i, int(junk is None), 0))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "long " + "word other " * 40_000)]
    rows += [(504, rows[0][1]), (0, rows[0][1]), (None, rows[0][1])]
    labels += [(0, 0, 0), (0, 1, 0), (900, 1, 0), (None, 1, 1), (7, None, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = classify(spark, documents(rows, extra=True), table).collect()
    assert len(found) == len(rows)
    truth = {i: q for i, q, _ in labels[:400]}
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 50
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    same = {r.score for r in found if r.doc_id in (504, 0, None)}
    assert len(same) == 1
    assert len({r.score for r in found if r.doc_id in (500, 501, 502)}) == 1


def test_labels_of_one_kind_or_none(spark, documents):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    df = documents([(1, "some words"), (2, None)])
    assert {r.score for r in classify(spark, df, empty).collect() if r.doc_id == 2} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert all(r.predicted == 1 for r in classify(spark, df, ones).collect())
    assert classify(spark, documents([]), ones).collect() == []
    assert FEATURES == 14
