"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLES[name], SF, con)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["location", "n_false", "n_true", "total", "match_percentage"]
    assert df.count() > 0
