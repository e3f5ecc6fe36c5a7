import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from farezone.session import get_session

    s = get_session(master="local[*]", shuffle_partitions=8, app="farezone-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="farezone-test-ckpt-")})
    yield s


@pytest.fixture(scope="session")
def params():
    from farezone.config import fixture_params

    return fixture_params()
