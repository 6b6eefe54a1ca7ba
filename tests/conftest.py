import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("FERROLEX_DRIVER_MEMORY", "6g")


@pytest.fixture(scope="session")
def spark():
    from ferrolex.session import local_session

    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test data on this machine")
    return SF
