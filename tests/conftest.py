import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cardwatch.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="cardwatch-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture()
def scratch():
    """A fresh folder per test (never cleaned by the tests themselves)."""
    import tempfile

    return tempfile.mkdtemp(prefix="cardwatch-test-")
