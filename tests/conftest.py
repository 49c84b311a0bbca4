import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vigil import session
    s = session.get("local[4]", 4, app_name="vigil-tests", driver_memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def cat(spark):
    from vigil.plans import catalog
    return catalog.get(spark, SF)
