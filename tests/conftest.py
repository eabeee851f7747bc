import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventflow import configure

    session = (
        SparkSession.builder.master("local[4]")
        .appName("eventflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def row(spark):
    """Run an operator on one row (given as DDL and values) and return the resulting dicts."""

    def run(op, schema, *values, **config):
        df = spark.createDataFrame([tuple(v) for v in values], schema)
        return [r.asDict(recursive=True) for r in op(df, **config).collect()]

    return run
