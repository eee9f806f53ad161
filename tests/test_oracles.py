"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    sql = E.oracle_sql().get(key)
    if sql is None:
        df.count()
        return
    problems, _ = compare(df, con, sql)
    assert not problems, problems


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["action_type_name", "logs"]
    assert df.count() > 0
