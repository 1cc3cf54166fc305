import pytest

from linkmill.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def edges_of(spark):
    def build(pairs):
        return spark.createDataFrame(list(pairs), "src string, dst string")

    return build


@pytest.fixture(scope="session")
def lines_of(spark):
    def build(lines):
        return spark.createDataFrame([(line,) for line in lines], "value string")

    return build
