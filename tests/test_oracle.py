"""Every registered query against its DuckDB twin on the sf0.01 tables."""

import pytest

import __spark_entry__ as E
from barsmith.plans.compare import compare, duck_connection
from barsmith.plans.oracle import oracle_sql
from barsmith.plans.registry import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], oracle_sql()[name], SF)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 110
    assert "signal_regime" in df.columns
