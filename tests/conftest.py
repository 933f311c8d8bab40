import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from broadsheet.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, shuffle_partitions=4, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
