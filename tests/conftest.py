import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (sys.path[0], os.environ.get("PYTHONPATH")) if x)


@pytest.fixture(scope="session")
def spark():
    from trailmark.session import local_session

    s = local_session("tests", cores="4", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
