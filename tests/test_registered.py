"""Every registered query against its SQL twin, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from clipyard.plans.registry import QUERIES
from compare import connect, spark_digest, sql_digest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


#: Queries of the optional subpackage have tests of their own.
NAMES = sorted(QUERIES)


def test_every_query_has_a_twin():
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    got = spark_digest(entry.queries()[name](spark, SF))
    assert got[1] > 0, "nothing is compared with nothing"
    assert got == sql_digest(connect(SF), entry.oracle_sql()[name])


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns[:2] == ["rep_a", "rep_b"]
    assert found.count() > 0
