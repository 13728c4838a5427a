import pytest

from teletally.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "teletally-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(shared),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
