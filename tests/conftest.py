import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="churnlab-test-")
    s = (SparkSession.builder.master("local[4]").appName("churnlab-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.driver.memory", "8g")
         .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from churnlab.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="churnlab-t-")
