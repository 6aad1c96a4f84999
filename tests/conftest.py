import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from arlark.session import build_session, prepare

    s = build_session("local[*]", app_name="arlark-tests", shuffle_partitions=8)
    prepare(s)
    yield s
    s.stop()
