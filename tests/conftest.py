import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
