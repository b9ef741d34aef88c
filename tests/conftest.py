import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nearcast.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    extra = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="nearcast-test-ckpt-"),
             "spark.driver.memory": "4g"}
    # extra settings for a run, e.g. NEARCAST_SPARK_CONF="spark.sql.x=1,spark.sql.y=2"
    for kv in filter(None, os.environ.get("NEARCAST_SPARK_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        extra[k] = v
    s = build_session("local[4]", shuffle_partitions=4, extra=extra)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="nearcast-test-")
