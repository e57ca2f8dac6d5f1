import pytest

from scholmill.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("tests", shuffle_partitions=4, driver_memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
