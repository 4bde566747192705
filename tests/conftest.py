import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tsquality.session import build_session
    s = build_session("local[4]", app="tsquality-tests", shuffle_partitions=4,
                      extra={"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("run"))


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
