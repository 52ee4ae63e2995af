import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from gridmeter.session import checkpoint_dir, get_session
    s = get_session("local[4]", app="gridmeter-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    """A fresh scratch folder for each test (never reused)."""
    return tempfile.mkdtemp(prefix="gridmeter-test-")
