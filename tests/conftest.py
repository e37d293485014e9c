import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoal.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="shoal-tests", shuffle_partitions=8)
    # tests own their checkpoint folder; on a cluster the deployment sets it
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shoal-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
