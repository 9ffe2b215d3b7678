import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

os.environ.setdefault("NOTELAKE_DRIVER_MEMORY", "4g")

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from notelake.session import get_session
    s = get_session("local[*]", shuffle_partitions=8, app_name="notelake-tests")
    yield s
    s.stop()
