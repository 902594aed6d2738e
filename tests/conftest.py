import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
         .config("spark.driver.memory", "6g").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)
