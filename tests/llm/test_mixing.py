from __future__ import annotations

import pytest

from tallyloom.llm import mixing
from tallyloom.llm.mixing import mix


def water_fill(sizes, weights, total, epochs=3.0):
    """Plain Python: clamp what is above its maximum, share the rest again."""
    targets = [0.0] * len(sizes)
    open_, left = [i for i, w in enumerate(weights) if w > 0], float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        above = {i for i in open_ if left * weights[i] / weight > epochs * sizes[i]}
        for i in open_:
            targets[i] = epochs * sizes[i] if i in above else left * weights[i] / weight
        left -= sum(targets[i] for i in above)
        open_ = [i for i in open_ if i not in above] if above else []
    return targets


def repetitions(target, size):
    """How often all of a source is taken, and how many words more."""
    whole = int(target // size) if size else 0
    return (whole, round(target - whole * size)) if size else (0, 0)


def filled(spark, sizes, weights=(5.0, 2.0, 1.0)):
    rows = [(f"s{i:07d}", size, 1) for i, size in enumerate(sizes)]
    df = spark.createDataFrame(rows, "source string, source_size long, n long").repartition(3)
    return [r.target for r in sorted(mixing.water_fill(spark, df, weights).collect(), key=lambda r: r.source)]


def test_water_fill(spark):
    assert water_fill([1, 100, 100], [5, 2, 1], 201) == [3, 132, 66]
    for sizes in ([10, 10], [1, 100, 100], [1, 2, 1000], [], [5, 0, 0], [0, 0], [7], [3, 3, 3, 3, 3, 3], [1, 50, 2, 9, 400, 3, 3, 8]):
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        assert filled(spark, sizes) == pytest.approx(water_fill(sizes, weights, sum(sizes)))
    assert filled(spark, [5, 5, 5, 5], (0.0, 1.0)) == [0, 10, 0, 10]
    assert filled(spark, [5, 1], (0.0, 1.0)) == [0, 3]  # more than there is: all at their maximum


def test_any_number_of_sources(spark):
    sizes = [(i * 7919) % 1000 + (10**6 if i % 1000 == 0 else 0) for i in range(150_000)]
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    assert filled(spark, sizes) == pytest.approx(water_fill(sizes, weights, sum(sizes)))


def test_targets_are_met(spark, documents, words, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 1)
    sources = ["a"] * 300 + ["b"] * 20 + ["c"] * 3 + ["é"] * 30 + ["Z"] * 40 + [None] * 5 + ["void"] * 2
    rows = [(i, words(1 + i % 50, i), s) for i, s in enumerate(sources) if s != "void"]
    rows += [(900, None, "void"), (901, " \n", "void"), (902, words(20_000, 1), "c"), (None, "no id", "a")]
    rows += [(903, "twice the same", "b"), (903, "twice the same", "b")]
    found = mix(spark, documents(rows, extra=True)).collect()
    assert len(found) == len(rows)
    size = {}
    for i, text, s in rows:
        size[s] = size.get(s, 0) + len((text or "").split())
    order = ["Z", "a", "b", "c", "void", "é", None]
    targets = water_fill([size[s] for s in order], [5, 2, 1, 5, 2, 1, 5], sum(size.values()))
    for source, target in zip(order, targets, strict=True):
        own = [r for r in found if r.source == source]
        assert {r.source_size for r in own} == {size[source]}
        assert {r.target for r in own} == {target}
        assert abs(sum(r.taken for r in own) - target) <= 0.5
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    again = mix(spark, documents(rows, parts=7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, found), key=str)


def test_empty_table(spark, documents):
    assert mix(spark, documents([])).collect() == []
