import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = build_session(master="local[4]", app="shelfwise-tests", shuffle_partitions=8,
                          extra={"spark.driver.memory": "4g"})
    if not spark.conf.get("spark.checkpoint.dir", None):
        # tests only: a local shared folder (a cluster sets spark.checkpoint.dir)
        base = tempfile.mkdtemp(prefix="shelfwise-test-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
