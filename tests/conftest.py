import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from rowloom.session import local_session

    session = local_session("4", partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A table of text columns, and others by DDL, from rows as dicts."""

    def make(rows, schema):
        names = [c.split()[0].strip("`") for c in schema.split(",")]
        return spark.createDataFrame([tuple(r.get(n.strip()) for n in names) for r in rows], schema)

    return make
