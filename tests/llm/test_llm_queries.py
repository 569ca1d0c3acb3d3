"""The queries with SQL next to it, on the smallest tables, and the names of all of them."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tallyloom.llm.queries import ORACLE, QUERIES
from tools.compare import difference, views

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality": {"doc_id", "held_out", "score", "predicted"},
    "op7_mixing": {"doc_id", "size", "source_size", "target", "taken"},
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return views(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_for_each_row_of_the_table(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert set(df.columns) >= COLUMNS[name]
    assert df.count() == con.execute("SELECT count(*) FROM documents").fetchone()[0]


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in entry.queries() if name.startswith("op")]
    assert sorted(n for n in numbers if n) == list(range(1, 14))
    assert "pipeline" in entry.queries()
