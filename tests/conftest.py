import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tidemark.session import build_session  # noqa: E402

from helpers import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="tidemark-tests")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def released(request):
    """What a test caches goes with it; later tests look for frames that are still held."""
    session = request.getfixturevalue("spark") if "spark" in request.fixturenames else None
    yield
    if session is not None:
        session.catalog.clearCache()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from tidemark.sources.tables import TABLES, table_path

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    return con
