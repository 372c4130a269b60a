import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from jobloom.plans.session import local_session

    os.environ.setdefault("JOBLOOM_DRIVER_MEMORY", "4g")
    return local_session(4, 4, "tests")


@pytest.fixture(scope="session")
def small():
    return SMALL
