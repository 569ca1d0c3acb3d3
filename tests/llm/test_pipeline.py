from __future__ import annotations

import hashlib
import random
import subprocess
import sys

import pytest

import corpus_pipeline
from tallyloom.llm.mixing import water_fill

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


@pytest.fixture
def corpus(spark, tmp_path, words):
    draw = random.Random(1)
    passage = words(25, 999)
    good = {i: f"{words(60 + i % 30, i)}.\nline of all sites\n{words(30, 500 + i)}." for i in range(120)}
    for i in range(5):
        good[130 + i] = good[i]  # exact copies
        good[140 + i] = good[i + 10].replace("line of all sites", "line of all sites", 1) + " tail"
        good[150 + i] = f"{words(40, 700 + i)} {passage} {words(30, 800 + i)}."
    bad = {200 + i: "\n".join(" ".join(["%%% ###"] * 9) for _ in range(4)) + f" {i}" for i in range(60)}
    rows = [(i, t, "en", f"s{i % 13}", len(t)) for i, t in {**good, **bad}.items()]
    rows += [(300, None, None, None, None), (301, "", "en", "s1", 0), (None, words(50, 4000), "en", "s2", 9)]
    rows += [(302, words(30, 4001), None, None, 1)]
    labels = [(i, int(i < 200), 0) for i in [*good, *bad] if draw.random() < 0.8]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(
        3
    ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, "no such")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    return str(tmp_path), rows, passage


def test_stages(spark, corpus, tmp_path):
    path, rows, passage = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == DOCUMENTS
        left[name] = {r.doc_id: r for r in docs.collect()}
    clean = {r[0] for r in rows} - set(range(200, 260))
    assert set(left["quality"]) == clean
    lines = left["line_dedup"]
    assert set(lines) == clean
    assert [i for i, r in lines.items() if r.text and "line of all sites" in r.text] == [0]
    assert all(r.n_chars == len(r.text) for r in lines.values() if r.text is not None)
    near = left["near_dedup"]
    gone = {130 + i for i in range(5)} | {140 + i for i in range(5)} | {301}
    assert set(near) == clean - gone  # of the null text and the empty one, the first stays
    held = {i for i, r in near.items() if r.text and len(shingles(r.text) & shingles(passage)) >= 0.8 * 21}
    assert held == {150 + i for i in range(5)}
    assert set(left["decontaminate"]) == set(near) - held

    mixed = corpus_pipeline.mixing(spark, docs, path).collect()
    size = {}
    for r in left["decontaminate"].values():
        size[r.source] = size.get(r.source, 0) + len((r.text or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    targets = water_fill([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], sum(size.values()))
    for source, target in zip(order, targets, strict=True):
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.taken for r in own) - target) <= 0.5
    for r in mixed:
        whole = (left["decontaminate"][r.doc_id].text or "").split()
        assert r.text.split() == whole[: r.taken] and r.n_chars == len(r.text)
    assert len({(r.doc_id, r.repetition) for r in mixed}) == len(mixed)


def test_reused_doc_ids_keep_each_clean_text(spark, documents, words):
    clean, copied, other = f"z {words(60, 1)}", f"a {words(60, 2)}", f"m {words(60, 3)}"
    rows = [(5, clean), (5, copied), (3, copied), (5, clean), (7, other), (7, f"{other} tail"), (None, copied)]
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, documents(rows, extra=True), "").collect()]
    seven = [text for i, text in kept if i == 7]
    assert len(seven) == 1 and seven[0] in (other, f"{other} tail")
    rest = sorted((i or 0, text) for i, text in kept if i != 7)
    assert rest == [(0, copied), (3, copied), (5, clean)]


def test_run_is_the_stages_and_repeats(spark, corpus):
    path, *_ = corpus

    def digest():
        lines = sorted(str(tuple(r)) for r in corpus_pipeline.run(spark, path).collect())
        return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()

    first = digest()
    assert first[0] > 50 and digest() == first


def test_repeated_rows_clashing_names_and_empty_tables(spark, corpus, tmp_path):
    path, rows, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    wide = docs.union(docs.where("doc_id < 20")).selectExpr(
        "*", *[f"'x' as {n}" for n in ("body", "label", "score", "places", "row", "taken", "repetition", "doc")]
    )
    names = [n for n, _ in corpus_pipeline.STAGES]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, wide, path).write.parquet(f"{tmp_path}/wide-{name}")
        wide = spark.read.parquet(f"{tmp_path}/wide-{name}")
        if k < len(names) - 1:
            assert set(DOCUMENTS) < set(wide.columns)
    assert wide.count() > 50
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), path).collect() == []


def test_entry_without_this_folder(tmp_path):
    """The other queries stay when the folder and the pipeline are gone."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('tallyloom.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 80 and not [n for n in e.queries() if n.startswith('op1') or n == 'pipeline']\n"
        "assert set(e.queries()) == set(e.oracle_sql())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True)
