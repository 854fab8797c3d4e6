import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("panelforge-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="pf-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="pf-test-")
