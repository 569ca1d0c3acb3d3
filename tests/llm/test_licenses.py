from __future__ import annotations

import re

import pytest

from tallyloom.llm.licenses import BASE, GATES, NAMES, STATEMENTS, rules, scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def naive(text, gated=False):
    """Base places by words, and detections by trying every rule on the joined words.

    With ``gated`` only texts that have a gate word; that no rule needs more is tested below.
    """
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, base = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += here
        base |= {label} if here else set()
    line = " " + " ".join(words) + " "
    found = []
    tried = rules() if not gated or any(g in line for g in GATES) else []
    for priority, label, _, expression, confidence in tried:
        for m in re.finditer(f"(?<= ){expression}(?= )", line):
            start = line[: m.start()].count(" ") - 1
            found.append((start, -(start + m[0].count(" ") + 1), priority, label, confidence))
    end, labels, score = 0, set(base), 0.95 if base else 0.0
    for _, back, _, label, confidence in sorted(found):
        if -back > end:
            end = -back
            labels.add(label)
            score = max(score, confidence)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), score,
    )


TEXTS = [
    None,
    "",
    "nothing here",
    "Released under the MIT License.",
    "Under THE\n-- MIT -- license; Licensed under the Apache License, Version 2.0.",
    "under the mit license under the mit license",
    "CC-BY-NC 4.0 and cc BY nc sa. Licensed under CC BY-NC-SA 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: GPL-3.0 or SPDX-License-Identifier: BSD-3-Clause",
    "Distributed under the terms of the GNU Lesser General Public License v2.1",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "All rights reserved. Placed in the public domain.",
    "Éunder the mit license, ünder the mit license",
    "provided under the Mozilla Public License 2.0 license",
    "subject to the terms of the BSD license; the new BSD license",
    "mit und der Lizenz, accord by nc",
    "word " * 30_000 + "under the mit license " + "x " * 10,
    "cc by nc " * 300,
]


def test_same_as_naive(spark, documents):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[3])]
    found = scan(documents(rows, extra=True)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = TEXTS[r.doc_id] if r.doc_id is not None else TEXTS[3]
        assert tuple(r)[1:] == naive(text), text and text[:80]


def test_expected_labels():
    assert naive(TEXTS[7])[5] == "gpl-3"
    assert naive(TEXTS[6])[4:6] == ("cc-by-nc", "cc-by-nc,cc-by-nc-sa")
    assert naive(TEXTS[9])[5] == "lgpl-2.1"


def test_rules_are_ordered_and_gated():
    listed = rules()
    assert len(listed) > 300
    assert [r[0] for r in listed] == list(range(len(listed)))
    for _, _, keyword, expression, _ in listed:
        plain = re.sub(r"\(\?:[^()]*\)\?|.\?", "", re.sub(r"\[sc\]", "s", expression))
        assert re.compile(expression)
        assert any(g in plain.replace("licens", "licen") for g in GATES), expression
        assert keyword.split()[0][:3] in expression


def spelled(parsed):
    """All texts that a parsed expression without unbounded repeats allows, look-arounds aside."""
    out = [""]
    for op, value in parsed:
        op = str(op)
        if op == "LITERAL":
            some = [chr(value)]
        elif op == "IN":
            some = [
                chr(c) for kind, v in value for c in ([v] if str(kind) == "LITERAL" else range(v[0], v[1] + 1))
            ]
        elif op == "BRANCH":
            some = [x for branch in value[1] for x in spelled(branch)]
        elif op == "SUBPATTERN":
            some = spelled(value[-1])
        elif op == "MAX_REPEAT":
            assert value[:2] == (0, 1)
            some = ["", *spelled(value[2])]
        else:
            assert op == "ASSERT"
            some = [""]
        out = [x + y for x in out for y in some]
    return out


def test_every_spelling_holds_its_keyword():
    for line in [*NAMES.strip().splitlines(), *STATEMENTS.strip().splitlines()]:
        _, keyword, expression = (x.strip() for x in line.split(" | ")[:3])
        for text in spelled(re._parser.parse(expression)):
            if re.fullmatch(f" {expression}(?= ) ", f" {text} "):
                assert f" {keyword} " in f" {text} ", (expression, text)


def test_names_written_as_one_word(spark, documents):
    rows = [(1, "Under the FreeBSD license."), (2, "Licensed under Apache2"), (3, "licensed under apache2 0")]
    found = {r.doc_id: (r.labels, r.score) for r in scan(documents(rows)).collect()}
    assert found == {1: ("bsd-2", 0.9), 2: ("apache-2", 0.95), 3: ("apache-2", 0.95)}


def test_empty_table(spark, documents):
    assert scan(documents([])).collect() == []


@pytest.mark.parametrize("phrase", list(BASE))
def test_base_phrase_alone(spark, documents, phrase):
    assert scan(documents([(1, phrase)])).head().first_word == 0
