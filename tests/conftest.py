import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from dealscope.session import local_session
    s = local_session(4, shuffle_partitions=4, app="dealscope-tests", driver_memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="dealscope-test-")
