import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fincrime.session import build_session, ensure_checkpoint_dir
    s = build_session("local[*]", 8)
    # tests set their own checkpoint folder only because none is configured
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="fincrime-test-ckpt-"))
    yield s
