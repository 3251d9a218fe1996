import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fleetlake.session import local_session, remove_scratch

    session = local_session("tests", cores="8", partitions=4)
    yield session
    remove_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from fleetlake.catalog.adapters import Tables

    return Tables(spark, SMALL)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    from fleetlake.catalog.adapters import BASE_TABLES

    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con
