import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rtdw.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="rtdw-tests")
    yield s
    s.stop()
