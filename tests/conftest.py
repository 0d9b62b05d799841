import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from captrail.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, 8)
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
