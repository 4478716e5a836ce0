"""Every registered query beside its SQL on the smallest test data."""

import os

import pytest
from compare import differences, duck

import __spark_entry__ as entry_points
from parcelpulse.checks.oracles import ORACLES
from parcelpulse.checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_points_hold_all():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], con) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 126
