import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pitboss.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="pitboss-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def bronze(spark):
    from pitboss.sources.adapters import Bronze
    return Bronze(spark, SF001)
