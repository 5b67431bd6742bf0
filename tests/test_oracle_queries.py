"""Every core query with SQL gives the rows of its SQL; the others give rows."""

import os

import oracle
import pytest

from rowloom.plans import core_queries

FOLDER = f"{oracle.DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(core_queries.queries()))
def test_query(spark, con, name):
    query, sql = core_queries.queries()[name], core_queries.oracle_sql().get(name)
    if sql is None:
        assert query(spark, FOLDER).count() > 0
    else:
        assert oracle.compare(spark, con, query, sql, FOLDER) is None


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "degree_match_status" in df.columns
