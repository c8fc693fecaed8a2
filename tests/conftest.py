import pytest

from statuta.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
