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
    from chunkwise.session import get_session, scratch_dir

    s = get_session("local[4]", app="chunkwise-tests", shuffle_partitions=4)
    # the session's spark.checkpoint.dir is used when set; scratch_dir creates a
    # temporary one only where it is unset
    scratch_dir(s)
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="chunkwise-test-")
