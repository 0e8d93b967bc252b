import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from salescope.session import build_session
    s = build_session(master="local[2]", shuffle_partitions=4,
                      extra={"spark.sql.adaptive.enabled": "true"})
    yield s
    s.stop()
