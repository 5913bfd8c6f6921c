"""Every registered query against its SQL oracle, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from curbline.plans.queries import all_oracles, all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_entry_has_rows(spark):
    found = contract.entry(spark)
    assert found.columns == ["borough_pickup", "borough_dropoff", "total_trips"]
    assert found.count() == 25


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)
