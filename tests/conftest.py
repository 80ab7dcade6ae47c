import pytest

from tidemark.session import build


@pytest.fixture(scope="session")
def spark():
    session = build("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
