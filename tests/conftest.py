import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=4)
    checkpoint_dir(s, tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s
    s.stop()
