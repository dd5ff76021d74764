import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonekit.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # a warehouse of its own, so that a run that was broken off leaves no table in the way of the next
    conf = {"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="zonekit-warehouse-")}
    s = get_session("local[4]", app_name="zonekit-tests", shuffle_partitions=8, conf=conf)
    checkpoint_dir(s, tempfile.mkdtemp(prefix="zonekit-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="zonekit-test-")
