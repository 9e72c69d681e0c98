"""One local session for all tests."""

from __future__ import annotations

import pytest

from tidemill.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[4]", shuffle_partitions=4, **{"spark.default.parallelism": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
