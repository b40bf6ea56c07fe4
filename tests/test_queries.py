"""Every registered query against its SQL, over the whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from suite.registry import ORACLES, QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SF) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_id", "event_ts", "event_type", "event_value", "user_email", "user_id"]
    assert df.count() > 0
