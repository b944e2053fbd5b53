"""Every registered query against its SQL on DuckDB."""

import pytest
from compare import TESTDATA, compare, duck

import __spark_entry__ as entry
from tillstar.plans.oracle import ORACLE
from tillstar.plans.queries import QUERIES

FOLDER = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None
