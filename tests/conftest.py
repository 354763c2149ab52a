import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sixfold.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(app="sixfold-tests", shuffle_partitions=4)
    yield s
    s.stop()
