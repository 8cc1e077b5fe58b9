import pytest

from staffflow.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "staffflow-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
