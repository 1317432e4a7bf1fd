import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from terrace.session import build_session
    s = build_session("local[*]", "terrace-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_run():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
