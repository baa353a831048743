"""Registered queries against their SQL on the smallest shared tables."""

import pytest

from harness.compare import _bag, connect
from layerloom.llm.oracles import ORACLES
from layerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    con = connect(SF)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert _bag(df.collect(), df.columns) == _bag(result.fetchall(), names)
    con.close()
