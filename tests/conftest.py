import pytest

from tallyward.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(cores=8, app="tallyward-tests", shared=shared)
    yield session
    session.stop()
