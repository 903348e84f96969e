import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from starmart.session import clean_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=8, shuffle_partitions=8, app="starmart-tests")
    yield s
    clean_scratch(s)


@pytest.fixture()
def scratch(spark):
    from starmart.session import scratch_path
    return lambda name: scratch_path(spark, name)
