import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pathweave.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pw-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF001
