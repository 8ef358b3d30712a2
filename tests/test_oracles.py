"""Every named query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from lakekeel.oracles import all_oracles
from lakekeel.registry import all_queries
from tests.oracle_check import TESTDATA, differences, oracle_frame

SF_DIR = os.environ.get("ORACLE_SF_DIR", f"{TESTDATA}/sf0.001")


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_sql(spark, name):
    ours = entry.queries()[name](spark, SF_DIR).toArrow()
    assert differences(ours, oracle_frame(SF_DIR, entry.oracle_sql()[name])) == []


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(all_oracles()) == set(all_queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
