import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="policypanel-wh-")))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder only where the session names none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        root = tempfile.mkdtemp(prefix="policypanel-test-")
        s.conf.set("spark.checkpoint.dir", root)
        s.sparkContext.setCheckpointDir(root)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="policypanel-t-")
