"""Every registered query against its SQL (whole tables, small scale factor)."""

import os

import oracle
import pytest

from vitalmart.registry import ORACLES, QUERIES

SF = os.environ.get("VITALMART_TEST_SF", "0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    state, note = oracle.compare(spark, duck, name, QUERIES[name], ORACLES.get(name), SF)
    # a date filter may keep no row of the smallest tables; both sides must agree on that
    assert state in ("ok", "rows", "EMPTY"), note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
