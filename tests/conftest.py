import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldlab.session import local_session  # noqa: E402
from fieldlab.sources.tables import Store  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def store(spark):
    return Store(spark, SMALL)


@pytest.fixture
def frame(spark):
    """Make a small table: ``frame("a int, b string", (1, "x"), ...)``."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def values(df, *order):
    """Rows of a small result as tuples, sorted by the given columns or by everything."""
    rows = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return rows if order else sorted(rows, key=str)
