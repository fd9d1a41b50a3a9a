import pytest

from tests.oracle import TESTDATA, connect
from tracklab.session import local_session

SMALL = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="tracklab-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)
