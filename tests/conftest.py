import pytest

from millrace.session import build_session, set_checkpoint_dir


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[4]", cores=4)
    session.sparkContext.setLogLevel("ERROR")
    set_checkpoint_dir(session, str(tmp_path_factory.mktemp("checkpoint")))
    return session
