import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from racelake.session import DEFAULT_CONF

    builder = (SparkSession.builder.master("local[4]").appName("racelake-tests")
               .config("spark.sql.shuffle.partitions", "8")
               # Tests set their own shared folder; a cluster names one itself.
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="racelake-test-")))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR
