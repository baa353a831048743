"""Every registered query against its SQL on the smallest shared tables."""

import pytest

import __spark_entry__ as entry
from harness.compare import compare, connect
from harness.oracles import ORACLES
from harness.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sql, name):
    assert compare(spark, sql, SF, name) == []


def test_entry_points(spark):
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
