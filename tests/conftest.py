import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import get_spark
    s = get_spark(app="tidewater-tests", master="local[4]", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewater-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    from tidewater.session import scratch_dir
    return lambda name: scratch_dir(spark, name)
