import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("driftwatch-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        # Tests only: a bare local session gets its own checkpoint folder.
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="driftwatch-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="driftwatch-test-")
