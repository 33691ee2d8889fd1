"""Queries with SQL against DuckDB on the smallest data. Those that other test
files hold against brute force on the same tables are only bound here."""

import pytest

from tallyspark.checks.compare import compare, duck
from tallyspark.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op2_sainte_lague_mix"])
def test_query_matches_sql(spark, sf_small, name):
    r = compare(QUERIES[name](spark, sf_small), duck(sf_small), ORACLES[name])
    assert r["columns_match"] and r["hash_match"], r


def test_every_statement_binds(sf_small):
    con = duck(sf_small)
    for sql in ORACLES.values():
        con.execute(f"EXPLAIN {sql}")
