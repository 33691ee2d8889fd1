"""Every registered query against its DuckDB oracle (the driver's gate) on
the smallest testdata scale; run ``tests/run_oracles.py`` for sf0.01."""

import pytest

import __spark_entry__ as E
from tallyspark.checks.compare import compare, duck

# The training-data queries have tests of their own (tests/llm).
NAMES = [n for n in E.queries() if n not in E._training_data()[0]]


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    r = compare(df, con, E.oracle_sql()[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns


def test_registered_names_follow_the_contract():
    import re
    assert len(NAMES) == len(set(NAMES)) >= 53
    assert not [n for n in NAMES if "pipeline" in n or re.match(r"op\d+_", n)]


def test_every_oracle_statement_binds(con):
    for name, sql in E.oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")  # parses and binds against the testdata views
