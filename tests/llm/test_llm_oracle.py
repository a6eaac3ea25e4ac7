"""The operator queries that SQL can express against their DuckDB twins on the sf0.01 tables."""

import pytest

from barsmith.llm.oracle import ORACLE_SQL
from barsmith.llm.queries import QUERIES
from barsmith.plans.compare import compare, duck_connection

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck_connection(SF), name, QUERIES[name], ORACLE_SQL[name], SF)
    assert r["ok"], r
