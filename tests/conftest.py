import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from telemetra.session import local_session

    s = local_session(4, shuffle_partitions=4, app="telemetra-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def workdir(spark):
    from telemetra.session import work_dir

    return work_dir(spark, "test")
