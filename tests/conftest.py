import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from staffline.session import build_session
    # Tests set their own checkpoint folder (a cluster names a shared one).
    ckpt = tempfile.mkdtemp(prefix="staffline-test-ckpt-")
    s = build_session("local[4]", 8, app_name="staffline-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
