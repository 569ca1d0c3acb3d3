from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, source]) rows, with further columns whose names operators use inside."""

    def make(rows, extra=False, parts=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s0", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts)
        if extra:
            names = ("body", "label", "size", "one", "score", "places", "row", "n_lines", "taken", "range")
            df = df.selectExpr("*", *[f"'x' as {n}" for n in names])
        return df

    return make


@pytest.fixture
def words():
    """Text of n words that depend on a seed."""

    def make(n, seed):
        return " ".join(f"w{(i * 7919 + seed * 104729) % 1_000_003}" for i in range(n))

    return make
