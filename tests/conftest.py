import pytest

from waitflow.session import local


@pytest.fixture(scope="session")
def spark():
    session = local(4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"
