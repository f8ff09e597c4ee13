import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="cartwheel-tests")
    yield s
    s.stop()
