from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(made)).getOrCreate()
    )
    yield session
    session.stop()
