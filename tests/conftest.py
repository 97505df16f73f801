import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tideline.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="tideline-tests")
    yield s


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder under the shared checkpoint folder."""
    from tideline.session import scratch_dir

    return scratch_dir(spark, "test")
