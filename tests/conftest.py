import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
# Scale factor of the oracle-equivalence tests (LEDGERLINE_ORACLE_SF=/root/testdata/sf0.1 ...).
SF_CHECK = os.environ.get("LEDGERLINE_ORACLE_SF", SF_SMALL)
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from ledgerline.session import build_session
    s = build_session("local[4]", 4, extra={
        "spark.ui.showConsoleProgress": "false",
        # catalog tables of the tests go to a fresh folder, not the cwd
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-warehouse-", dir="/tmp")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from tools.compare import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    return con
