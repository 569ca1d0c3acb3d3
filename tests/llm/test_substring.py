from __future__ import annotations

import hashlib

from tallyloom.llm.substring import remove_repeats


def expected(rows, window):
    seen, out = {}, []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            if doc_id is not None:
                key = tuple(words[i : i + window])
                seen[key] = min(seen.get(key, doc_id), doc_id)
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            least = seen.get(tuple(words[i : i + window]))
            if doc_id is not None and least is not None and least < doc_id:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_same_as_brute_force(spark, documents, words):
    passage = words(70, 1)
    rows = [
        (1, f"{words(30, 2)} {passage} {words(40, 3)}"),
        (2, f"{words(11, 4)}\n{passage}\t{words(5, 5)}"),
        (3, passage),
        (4, words(30, 2) + " " + passage),  # longer match with 1 than with the others
        (5, words(49, 1)),  # shorter than a window
        (6, f"{passage} {passage}"),  # repeats itself
        (7, words(600, 9)),
        (8, "a " * 5000),
        (9, "a " * 60),
        (9, words(55, 1)),  # a second row with one id
        (10, ""),
        (11, None),
        (None, passage),
        (12, "a b " + words(80, 9) + " é ü"),
        (12, "a b " + words(80, 9) + " é ü"),
    ]
    assert got(remove_repeats(spark, documents(rows, extra=True))) == expected(rows, 50)


def test_hot_passage_in_many_documents(spark, documents, words):
    passage = words(60, 1)
    rows = [(i, f"{words(20 + i % 7, 100 + i)} {passage} {words(30, 500 + i)}") for i in range(120)]
    assert got(remove_repeats(spark, documents(rows, parts=7))) == expected(rows, 50)


def test_short_windows_and_text(spark, documents, words):
    rows = [(i, words(12, i % 5)) for i in range(20)]
    found = remove_repeats(spark, documents(rows), window=8, keep_text=True)
    assert got(found.drop("kept_text")) == expected(rows, 8)
    assert {r.kept_text for r in found.where("doc_id < 5").collect()} == {words(12, i) for i in range(5)}


def test_empty_table(spark, documents):
    assert remove_repeats(spark, documents([])).collect() == []
