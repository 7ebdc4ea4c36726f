import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stationlake.session import build_session

    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    # a fresh scratch folder per test (never reused, never cleared)
    return tempfile.mkdtemp(prefix="stationlake-test-")
