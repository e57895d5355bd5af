import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import build_session
    s = build_session("local[*]", 8, "riskloom-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def x001(spark):
    from riskloom.plans.context import Inputs
    return Inputs(spark, SF001)


@pytest.fixture(scope="session")
def x01(spark):
    from riskloom.plans.context import Inputs
    return Inputs(spark, SF01)
