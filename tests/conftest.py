import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from framelake.session import local_session

    from framelake.session import ship_to_workers

    s = local_session(cores="*", shuffle_partitions=8, app="framelake-tests")
    ship_to_workers(s, os.path.dirname(os.path.abspath(__file__)))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
