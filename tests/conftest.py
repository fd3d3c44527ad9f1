import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from txnwatch.session import local_session
    s = local_session(cores="*", shuffle_partitions=8,
                      scratch=tempfile.mkdtemp(prefix="txnwatch-test-ck-", dir="/tmp"))
    s.sparkContext.environment["PYTHONPATH"] = ROOT  # Python workers find the package where the tests do
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from txnwatch.plans.fixtures import DRIVER_TABLES
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con
