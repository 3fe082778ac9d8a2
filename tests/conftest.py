import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickyard.session import get_session
    s = get_session("local[4]", 4, app_name="tickyard-tests", driver_memory="4g")
    yield s
    s.stop()
