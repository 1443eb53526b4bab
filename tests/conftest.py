import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    """The one session of a test run; subfolders use it too."""
    yield get_session(master="local[*]", shuffle_partitions=8, extra={"spark.driver.memory": "12g"})


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="docloom-test-")
