import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from safetylake.session import shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]")
         .appName("safetylake-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="safetylake-test-warehouse-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)           # the configured checkpoint folder, or a temporary one if unset
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="safetylake-test-")
