"""Every query against its SQL on DuckDB, at the smallest scale."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from oracle_check import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.count() > 0 and df.columns


def test_entry_has_rows_and_a_fixed_schema(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "split", "label", "n", "n_price", "n_max_price", "avg_price", "avg_lines"]
    assert df.count() == 4


def test_every_oracle_names_a_query():
    assert set(ORACLES) <= set(QUERIES)
