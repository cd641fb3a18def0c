import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quotalens.session import get_session
    s = get_session("local[4]", 4, driver_memory="6g")
    yield s


@pytest.fixture(scope="session")
def src(spark):
    from quotalens.plans.catalog import sources_for
    return sources_for(spark, SF)


@pytest.fixture(scope="session")
def oct_params(src):
    from quotalens.operators.params import params
    return params(src, "PU1", ["October 1998"])
