import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tallyloom.session import local_session

    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a small table from tuples and a DDL schema."""

    def build(data, schema):
        return spark.createDataFrame(data, schema)

    return build


def collected(df, *order):
    """Rows as tuples in a stable order."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
