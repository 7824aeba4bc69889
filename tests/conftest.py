import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from paperlane.session import build_session

    s = build_session("local[4]", "paperlane-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paperlane-test-ckpt-"))
    yield s
    s.stop()


def one_col(spark, values, name="v", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")
