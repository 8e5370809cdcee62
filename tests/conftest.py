import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from contestlab.session import local_session

    s = local_session("*", shuffle_partitions=8, app="contestlab-tests")
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
