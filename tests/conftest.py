import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from tracewright.functions.shared import local_session, ship

    session = local_session("tests", 4, 4)
    session.sparkContext.setLogLevel("OFF")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
