import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vistra.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="vistra-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from vistra.session import scratch_path

    return scratch_path(spark, "test")
