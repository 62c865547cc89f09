from __future__ import annotations

import datetime as dt
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tierstone.session import local_session  # noqa: E402
from tierstone.workload.trades import history  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tierstone-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def trades(spark, sf_dir):
    return history(spark, sf_dir).trades


@pytest.fixture(scope="session")
def legacy(spark, sf_dir):
    return history(spark, sf_dir).legacy


@pytest.fixture(scope="session")
def recent(spark, sf_dir, tmp_path_factory):
    """The last five months of the history, kept in memory for the job tests."""
    from tierstone.sources.scans import date_window

    frame = date_window(history(spark, sf_dir).trades, dt.date(2001, 7, 1)).cache()
    frame.count()
    return frame


@pytest.fixture
def folder(tmp_path):
    return f"file:{tmp_path}"
