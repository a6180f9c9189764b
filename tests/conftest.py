import pytest

from vecquery.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=4)
    yield session
    session.stop()
