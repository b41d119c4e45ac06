"""Every query that has SQL must return the same rows as that SQL."""

import pytest

from casegrid.workload import ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None
