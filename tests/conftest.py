import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tidemark-tests-")
    s = (SparkSession.builder.master("local[4]").appName("tidemark-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", scratch)
    yield s


@pytest.fixture
def scratch(spark):
    from tidemark.session import fresh_dir, local_path
    p = local_path(fresh_dir(spark, "test"))
    os.makedirs(p, exist_ok=True)
    return p


T1 = dt.datetime(2024, 1, 1, 10, 0, 0)
T2 = dt.datetime(2024, 1, 2, 10, 0, 0)
