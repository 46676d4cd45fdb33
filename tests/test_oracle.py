"""Every registered query against its SQL on the smallest given tables."""

import __spark_entry__ as entry
import oracle
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        problem = oracle.compare(df, con, sql)
        assert problem is None or problem == "both sides are empty", problem
