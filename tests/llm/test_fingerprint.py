from __future__ import annotations

import hashlib

import numpy as np

from tallyloom.llm import fingerprint as f


def one(text):
    raw = text.encode()
    return f.fingerprints(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        mine = one(text)
        out[i] = (
            len(text),
            hashlib.sha256(new.encode()).hexdigest(),
            f.as_text(mine),
            f.as_text(one(new)),
            f.containment(mine, one(new)),
            f.containment(mine, one(after)),
        )
    return out


def test_same_as_one_by_one(spark, documents, words, monkeypatch):
    monkeypatch.setattr(f, "ROWS_PER_RANGE", 5)
    rows = [(i * 3, words(20 + i * 11, i)) for i in range(60)]
    rows += [(1000, None), (1001, ""), (1002, "é" * 301), (1003, "𝄞🙂 " * 50), (1004, "x"), (1005, words(9000, 4))]
    rows += [(None, "no id, but some text"), (-4, words(80, 2)), (1006, words(80, 2))]
    found = f.compare_with_edits(spark, documents(rows, extra=True, parts=4)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == expected(rows)
    assert len(found) == len(rows)
    prints = {r.doc_id: r.fingerprint for r in found}
    assert prints[-4] == prints[1006] and prints[1000] == prints[1001] == ""


def test_few_rows(spark, documents):
    assert f.compare_with_edits(spark, documents([])).collect() == []
    alone = f.compare_with_edits(spark, documents([(5, "alone with itself")])).collect()
    assert alone[0].near_next == 1.0
    twice = f.compare_with_edits(spark, documents([(5, "one text"), (5, "one text"), (5, "another")]))
    assert twice.count() == 3


def test_chunks_resist_shifts(words):
    text = words(2000, 1)
    moved = "a few words put before " + text[:5000] + " and some within " + text[5000:]
    assert f.containment(one(text), one(moved)) > 0.95
    assert f.containment(one(text), one(words(2000, 2))) < 0.05


def test_chunk_sizes(words):
    raw = np.frombuffer((words(5000, 1) + "z" * 1000).encode(), np.uint8)
    sizes = np.diff(np.concatenate(([0], f.chunk_ends(raw, np.array([0, len(raw)])))))
    assert sizes.sum() == len(raw) and sizes.max() <= f.MOST and sizes[:-1].min() > f.LEAST - 1
