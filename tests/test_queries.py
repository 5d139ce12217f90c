"""Every checked query against its SQL at the smallest scale."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect
from workload import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF)
    yield connection
    connection.close()


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    problem = compare(spark, duck, name, queries()[name], oracle_sql()[name], SF)
    assert problem in (None, "both empty")
