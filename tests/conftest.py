import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cmdeval.session import local_session
    s = local_session("*", shuffle_partitions=8, app="cmdeval-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
