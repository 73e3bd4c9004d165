import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from allelespan import reachable  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"}
    s = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    reachable(s)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
