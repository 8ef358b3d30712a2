from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakekeel.session import configure, workspace  # noqa: E402
from tests.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session())
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return workspace(spark, "test")


@pytest.fixture
def no_broadcast(spark):
    """Every side counts as too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
