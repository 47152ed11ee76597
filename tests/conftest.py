import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from trendstream.session import build_session, shared_dir
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="trendstream-tests")
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from trendstream.plans.verify import duck
    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_mid():
    from trendstream.plans.verify import duck
    return duck(SF_MID)
