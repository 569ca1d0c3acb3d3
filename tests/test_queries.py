"""The query catalogue next to its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tallyloom.queries import ORACLE, QUERIES
from tools.compare import difference, views

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return views(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == ""


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_flagship(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 64
    assert df.count() > 0
