"""Registered queries of the subpackage that SQL can express equal their DuckDB oracle."""

import pytest

from conftest import SF0001
from netquery.llm.queries import ORACLE, QUERIES
from oracle_harness import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF0001, con)
    assert r["ok"], r


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_entry_registers_them_and_the_pipeline():
    import __spark_entry__ as e
    assert {*QUERIES, "pipeline"} <= set(e.queries())
