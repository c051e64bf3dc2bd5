"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

for _p in (Path(__file__).resolve().parents[1], Path(__file__).resolve().parent):
    sys.path.insert(0, str(_p))


@pytest.fixture(scope="session")
def spark():
    from creditloom.session import local_session

    session = local_session("4", "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def shared(spark):
    """Makes paths below the shared scratch folder."""
    from creditloom.session import scratch_path

    return lambda name: scratch_path(spark, name)
