"""Registered queries against their SQL on the smallest tables."""
import pytest

from propensity.llm import queries
from tools.check_oracle import canon

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    found = canon(df.columns, [tuple(r) for r in df.collect()], 6)
    res = duck.execute(queries.SQL[name])
    want = canon([d[0] for d in res.description], res.fetchall(), 6)
    assert found == want


def test_all_operators_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
