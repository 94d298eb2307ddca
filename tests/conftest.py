import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lumenkg.session import build_session, checkpoint_dir
    s = build_session("local[*]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    checkpoint_dir(s)
    yield s
    s.stop()
