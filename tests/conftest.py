import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cctally.session import local_session
    s = local_session(app="cctally-tests", cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture()
def scratch(spark):
    from cctally.session import staging_dir
    path = staging_dir(spark, "test")
    # tests write their raw files with Python, so they need the local path
    return path[len("file:"):] if path.startswith("file:") else path
