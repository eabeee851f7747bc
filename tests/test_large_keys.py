"""Queries on copies of the tables with shifted keys, as large tables have them."""

from pyspark.sql import functions as F
from tests.oracle_check import compare

import eventflow_catalog


def shifted(spark, sf, path, copies, by):
    """Events repeated ``copies`` times, keys shifted by 100,000 events and ``by`` users each; returns DuckDB with them."""
    import duckdb

    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("copy", copy)
    moved = events.withColumns({"event_id": F.expr("event_id + copy * 100000"), "user_id": F.expr(f"user_id + copy * {by}")}).drop("copy")
    moved.write.parquet(f"{path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet/*.parquet'")
    return con


def test_clients_of_large_user_numbers(spark, sf, tmp_path):
    con = shifted(spark, sf, tmp_path, 3, 70_000)
    name = "grok_access_log"
    assert compare(spark, con, name, eventflow_catalog.QUERIES[name], eventflow_catalog.ORACLES[name], str(tmp_path)) is None
