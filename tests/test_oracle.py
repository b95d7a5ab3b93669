"""Every registered query against its oracle SQL on the smallest test tables."""

import os
import re

import pytest

import __spark_entry__ as driver
from oracle import connect, difference
from workload.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    frame = driver.queries()[name](spark, SF_DIR)
    assert difference(frame, duck, driver.oracle_sql()[name]) is None


def test_no_plan_has_a_cross_join(spark):
    for name, query in QUERIES.items():
        if name.startswith("stream_"):
            continue
        text = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_entry(spark):
    assert driver.entry(spark).count() > 0
