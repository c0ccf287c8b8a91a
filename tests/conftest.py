import os
import tempfile

import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-")
    builder = SparkSession.builder.master(f"local[{min(8, os.cpu_count() or 4)}]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
    conf = {"spark.sql.session.timeZone": "UTC", "spark.local.dir": folder, "spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.checkpoint.dir": f"{folder}/checkpoints", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"}
    session = builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
