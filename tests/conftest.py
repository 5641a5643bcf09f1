import pytest

from ledgerloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        "tests",
        spark__checkpoint__dir=str(folder),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
    )
    yield session
    session.stop()
