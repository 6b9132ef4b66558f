import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quorum.session import build_session
    s = build_session("local[4]", app="quorum-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="quorum-wh-"),
                             "spark.scheduler.mode": "FAIR"})
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="quorum-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture(scope="session")
def duck():
    from quorum.oracle.compare import duck_views
    return duck_views(SMALL)
