import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from venuelake.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", 8)
    s.conf.set("spark.sql.shuffle.partitions", "4")
    return s
