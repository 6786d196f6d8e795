import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratebook.session import build_session, checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="ratebook-tests", shuffle_partitions=8)
    # Tests may run where no shared checkpoint folder is configured.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="ratebook-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
