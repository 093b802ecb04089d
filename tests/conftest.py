import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from staykit.session import build_session, checkpoint_root  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(app="staykit-tests", master="local[4]", shuffle_partitions=4)
    checkpoint_root(s)   # uses spark.checkpoint.dir; sets a private one only if unset
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="staykit-case-")
