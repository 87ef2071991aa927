"""Every query of the package with SQL gives the same rows as DuckDB, and the pipeline and all queries are registered."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from clickloom.llm import queries as Q
from tests.oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_same_rows_as_sql(spark, con, name):
    ok, text = compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert ok, text


def test_one_query_per_operator_and_the_pipeline():
    numbers = sorted(int(name[2:].split("_")[0]) for name in Q.QUERIES)
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()
