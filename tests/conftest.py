import pytest

from gatelake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    yield session
    session.stop()
