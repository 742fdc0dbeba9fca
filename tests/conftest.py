import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("TZ", "UTC")
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "6g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
    }.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
