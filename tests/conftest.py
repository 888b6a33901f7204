import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from bundles.session import get_spark
    s = get_spark("local[*]", 8)
    # tests own their checkpoint folder (a cluster names one in spark.checkpoint.dir)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bundles-test-ckpt-"))
    yield s
    s.stop()
