"""The queries that SQL can express against their SQL on DuckDB, and the others' schemas."""

import pytest
from compare import TESTDATA, compare, duck

import __spark_entry__ as entry
from tillstar.llm.oracle import ORACLE
from tillstar.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    folder = f"{TESTDATA}/sf0.001"
    assert compare(QUERIES[name](spark, folder), duck(folder), ORACLE[name]) is None


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert len([n for n in QUERIES if n.startswith("op")]) == 13 and "pipeline" in QUERIES
