import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomstep.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    out = local_session("4", shuffle_partitions=4, driver_memory="4g")
    out.sparkContext.setLogLevel("ERROR")
    return out


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
