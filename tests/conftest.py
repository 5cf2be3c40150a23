import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from indistar.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", app_name="indistar-tests", shuffle_partitions=8,
                  driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture()
def tmp_uri(tmp_path):
    return str(tmp_path)
