from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    os.environ["TZ"] = "UTC"
    return (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]")
        .appName("riskflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()
