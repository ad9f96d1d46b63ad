"""Every registered query against its SQL twin, and the shape of its plan."""

import pytest
from check import differences, duck

from skyweave.queries import ORACLES, QUERIES

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, data, con, name):
    got = QUERIES[name](spark, data)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = got.toPandas()
    if name in ORACLES:
        assert differences(rows, con.execute(ORACLES[name]).df()) is None
    else:
        assert len(rows) > 0


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    flagship = entry.entry(spark)
    assert flagship.columns[0] == "slot" and flagship.count() > 0
