import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from leadlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=4, shuffle_partitions=4, memory="4g", warehouse=str(tmp_path_factory.mktemp("warehouse")))
    yield session
    session.stop()
