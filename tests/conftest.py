import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from skyledger.session import ensure_local_checkpoint_dir, get_session
    s = get_session("local[4]", app_name="skyledger-tests", shuffle_partitions=8)
    ensure_local_checkpoint_dir(s, tempfile.mkdtemp(prefix="skyledger-test-ckpt-"))
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="skyledger-test-")
