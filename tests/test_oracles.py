"""Every query with an SQL twin, on whole tables, in both engines."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracles import compare, connect  # noqa: E402

import __spark_entry__ as spark_entry  # noqa: E402

QUERIES, SQL = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_each_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, folder, name):
    mine = QUERIES[name](spark, folder).toPandas()
    assert compare(mine, duck.execute(SQL[name]).df()) == ""


def test_entry(spark):
    found = spark_entry.entry(spark)
    assert found.count() > 0
    assert found.columns[0] == "quarter"
