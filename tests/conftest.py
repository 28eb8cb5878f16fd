from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from maskwright import MaskContext


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session", params=["arrow", "columns"])
def context(request):
    return MaskContext("test-key", project="p", run_id="r1", text_engine=request.param)
