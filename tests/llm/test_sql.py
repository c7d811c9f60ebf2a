import pytest

from cardloom.llm.oracle import ORACLES
from cardloom.llm.queries import QUERIES
from checks.compare import connect, differences


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, sample, name):
    assert differences(QUERIES[name](spark, sample), connect(sample), ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_are_native_where_asked(spark, sample, name):
    if name.startswith(("op1_", "op4_", "op5_")):
        plan = QUERIES[name](spark, sample)._jdf.queryExecution().toString()
        assert "Python" not in plan and "InArrow" not in plan and "ArrowEval" not in plan
