from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from incidentia.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "incidentia-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows given as a list to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def column(frame, expression):
    return [r[0] for r in frame.select(expression).collect()]


def tuples(frame):
    return [tuple(r) for r in frame.collect()]
