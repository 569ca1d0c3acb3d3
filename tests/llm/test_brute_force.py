"""Queries that SQL can't express, and the pipeline, next to plain Python over the given tables."""

from __future__ import annotations

import hashlib
import html
import os
import re

import duckdb
import pytest
import test_decontaminate
import test_fingerprint
import test_licenses
import test_lines
import test_mixing
import test_near_dedup
import test_substring

import corpus_pipeline
from tallyloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LABELLED = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


def table(columns, name, sf_dir=SF_DIR):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def texts():
    return table("doc_id, text", "documents")


def test_quality_on_held_out_documents(spark):
    truth = dict(table("doc_id, quality", "labels", LABELLED))
    found = [r for r in QUERIES["op1_quality"](spark, LABELLED).collect() if r.held_out and r.doc_id in truth]
    assert len(found) > 50
    assert sum(r.predicted == truth[r.doc_id] for r in found) >= 0.97 * len(found)


def test_substring_dedup(spark, texts):
    found = QUERIES["op2_substring_dedup"](spark, SF_DIR)
    assert test_substring.got(found) == test_substring.expected(texts, 50)


def test_fingerprints(spark, texts):
    found = QUERIES["op3_fingerprints"](spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == test_fingerprint.expected(texts)


def test_license_scan(spark, texts):
    known = dict(texts)
    found = QUERIES["op5_license_scan"](spark, SF_DIR).collect()
    assert {r.doc_id for r in found} == set(known)
    for r in found:
        assert tuple(r)[1:] == test_licenses.naive(known[r.doc_id], gated=True)


def test_main_text(spark):
    want = {}
    for page_id, page in table("page_id, html", "pages"):
        article = re.search("<article>(.*?)</article>", page, re.S)[1]
        blocks = re.split("</?(?:p|h1|h2|pre|div|ul|li)>", article)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        want[page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in QUERIES["op9_main_text"](spark, SF_DIR).collect()} == want


def test_near_duplicates(spark, texts):
    assert test_near_dedup.got(QUERIES["op10_near_dedup"](spark, SF_DIR)) == test_near_dedup.expected(texts)


def mixed(rows):
    """(doc_id, repetition, taken) of rows (doc_id, source, words)."""
    size = {}
    for _, source, words in rows:
        size[source] = size.get(source, 0) + len(words)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weights = [(5, 2, 1)[i % 3] for i in range(len(order))]
    targets = dict(zip(order, test_mixing.water_fill([size[s] for s in order], weights, sum(size.values())), strict=True))
    ahead, out = {}, set()
    for doc_id, source, words in sorted(rows, key=lambda r: hashlib.md5(f"17|{r[0]}".encode()).hexdigest()):
        whole, part = test_mixing.repetitions(targets[source], size[source])
        more = max(0, min(len(words), part - ahead.get(source, 0)))
        ahead[source] = ahead.get(source, 0) + len(words)
        copies = [len(words)] * whole + [more]
        out |= {(doc_id, i, n) for i, n in enumerate(c for c in copies if c)}
    return out


def test_pipeline(spark):
    """All stages after the classifier, whose rejections are taken as they are, in plain Python."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF_DIR).select("doc_id").collect()}
    rows = [r for r in table("doc_id, text, source", "documents") if r[0] in kept]
    source = {i: s for i, _, s in rows}
    clean = {i: text for i, text, *_ in test_lines.expected(rows, 10)}
    classes = test_near_dedup.expected(sorted(clean.items()))
    single = [(i, clean[i]) for i in clean if classes[i] == i]
    held = {i for i, *_ in test_decontaminate.expected(single, table("item_id, text", "benchmark"))}
    left = {i: text for i, text in single if i not in held}
    want = mixed([(i, source[i], text.encode().split()) for i, text in left.items()])
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {(r.doc_id, r.repetition, r.taken) for r in found} == want and len(found) == len(want)
    for r in found:
        words = left[r.doc_id].encode().split()
        assert r.text.encode().split() == words[: r.taken]
        assert r.taken < len(words) or r.text == left[r.doc_id]
