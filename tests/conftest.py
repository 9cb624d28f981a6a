import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a set of tuples; arrays become tuples."""

    def freeze(value):
        return tuple(freeze(v) for v in value) if isinstance(value, (list, tuple)) else value

    def collect(df):
        return {freeze(tuple(r)) for r in df.collect()}

    return collect
