import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from stationflow.session import local_session, tuned  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = tuned(local_session(8))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("STATIONFLOW_SF_DIR", "/root/testdata/sf0.001")
