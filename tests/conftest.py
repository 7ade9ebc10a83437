import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stratum.session import build_session
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="stratum-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from stratum.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con
