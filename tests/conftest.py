import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from propensity.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="propensity-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from propensity.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con
