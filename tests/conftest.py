from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="eventide-test-")
    s = get_session("local[4]", app="eventide-tests", shuffle_partitions=8, conf={
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.sql.streaming.checkpointLocation": os.path.join(scratch, "stream-ckpt"),
    })
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="eventide-run-")
