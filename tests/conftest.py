import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelens.session import local_session, shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="pricelens-tests")
    shared_dir(s)  # registers a scratch checkpoint folder only if none is configured
    yield s


@pytest.fixture
def tmp_out(spark, tmp_path):
    """A fresh output folder per test (tests run on one machine, so a local temp
    folder is the shared folder here)."""
    return str(tmp_path)
