import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sparkmart.session import apply_runtime_conf, shared_dir

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(s)
    shared_dir(s)  # tests only: registers a local checkpoint folder because none is configured
    yield s


@pytest.fixture()
def tmp_root(spark):
    from sparkmart.session import scratch_path
    return scratch_path(spark, "test")


@pytest.fixture()
def local_tmp():
    return tempfile.mkdtemp(prefix="sparkmart-test-")
