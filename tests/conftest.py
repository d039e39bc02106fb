import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("TZ", "UTC")
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("4", "tests", **{"spark.checkpoint.dir": shared, "driver_memory": "6g"})
    yield session
    session.stop()
