"""Plan-level properties: no Python UDF in any SQL-checked operator, pushdown reaches the scan."""
import pytest

import __spark_entry__ as E
from conftest import SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")
CHEAP = ["campaign_frame", "threshold_sweep", "evaluate_all", "value_counts", "target_rate_by_category"]


@pytest.mark.parametrize("name", CHEAP)
def test_no_python_udf(spark, name):
    plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PY_NODES)


def test_column_pruning_reaches_scan(spark):
    from propensity.sources.campaign import line_summary
    plan = line_summary(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_partkey" not in plan
