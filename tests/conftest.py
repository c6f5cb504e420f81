import datetime as dt
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import recommended_conf  # noqa: E402
from tidemark.sources.store import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    for k, v in {**recommended_conf(), "spark.sql.shuffle.partitions": "2"}.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def wh(spark):
    return Warehouse(spark, tempfile.mkdtemp(prefix="tidemark-test-"))


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
