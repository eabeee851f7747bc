"""Registry of the catalogued queries and the tables they start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import eventflow as ef

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its DuckDB equivalent."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ef.configure(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their tenant (three of them) and dataset (the event type)."""
    return table(spark, sf_dir, "events").withColumns(
        {"tenant_id": F.expr("concat('t', user_id % 3)"), "dataset_id": F.col("event_type")}
    )


EVENTS = "(SELECT *, 't' || (user_id % 3) AS tenant_id, event_type AS dataset_id FROM events)"

# A common-log line per event; every seventh event has a line that fits no format.
ACCESS_LINE = """
    CASE WHEN event_id % 7 = 0 THEN concat('no log line ', event_id)
    ELSE concat('10.', user_id div 256, '.', user_id % 256, '.', event_id % 256, ' - u', user_id,
        ' [', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' +0000] "GET /', event_type,
        ' HTTP/1.1" ', CASE WHEN event_type = 'error' THEN 500 ELSE 200 END, ' ', event_id) END"""
ADDRESS = "'10.' || (user_id // 256) || '.' || (user_id % 256) || '.' || (event_id % 256)"
LOG_TIME = "strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000'"
STATUS = "CASE WHEN event_type = 'error' THEN 500 ELSE 200 END"


def rfc3339(column: str) -> str:
    """DuckDB text of a timestamp, seconds precision."""
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || 'Z'"
