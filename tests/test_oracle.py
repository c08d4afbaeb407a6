"""Every registered query with SQL against DuckDB on the smallest tables (the correctness gate)."""
import math

import pytest

import __spark_entry__ as E
from conftest import SMALL

SQL = E.oracle_sql()
QUERIES = E.queries()


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6) + 0.0
        return v
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_sql_key_is_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    res = duck.execute(SQL[name])
    c1, r1 = canon(df.columns, [tuple(r) for r in df.collect()])
    c2, r2 = canon([d[0] for d in res.description], res.fetchall())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "threshold" in df.columns
