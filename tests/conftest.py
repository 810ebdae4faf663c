import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from lakeload.session import SESSION_CONF

    base = tempfile.mkdtemp(prefix="lakeload-tests-")
    builder = SparkSession.builder.master("local[8]").appName("lakeload-tests")
    conf = {**SESSION_CONF, "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.driver.memory": "4g", "spark.sql.warehouse.dir": f"{base}/warehouse",
            "spark.checkpoint.dir": f"{base}/checkpoints", "spark.scheduler.mode": "FAIR"}
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
