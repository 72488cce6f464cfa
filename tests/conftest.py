import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewarden.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small DataFrames from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
