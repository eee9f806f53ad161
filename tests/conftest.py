import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
HERE = os.path.dirname(os.path.abspath(__file__))
if HERE not in sys.path:
    sys.path.insert(0, HERE)


@pytest.fixture(scope="session")
def spark():
    from logwright.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()
