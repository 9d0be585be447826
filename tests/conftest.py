from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from staylens.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app_name="staylens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from staylens.checks.compare import duckdb_connection

    return duckdb_connection(SF_SMALL)
