import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tidemark.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[4]").appName("tidemark-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "4g")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidemark-test-", dir="/tmp")
