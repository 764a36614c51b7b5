"""Every registered query against its SQL, over the smallest whole tables."""

import pytest

import __spark_entry__ as entry
from shiftlake.plans.queries import REGISTRY
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as c:
        yield c


# Queries of optional packages are tested beside those.
NAMES = sorted(REGISTRY)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) and set(NAMES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
