import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("fieldlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.log.level", "ERROR")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def apply(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield apply
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="session")
def small_dir():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test tables are not present")
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
