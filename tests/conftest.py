import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from stationqc.session import ensure_checkpoint_dir, get_spark

    s = get_spark("local[*]", "stationqc-tests", 8)
    ensure_checkpoint_dir(s, default=tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
