import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ladle.session import local_session

    os.environ.setdefault("LADLE_SCRATCH", tempfile.mkdtemp(prefix="ladle-tests-"))
    s = local_session("*", shuffle_partitions=8, app="ladle-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL
