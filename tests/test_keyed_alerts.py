"""Alerts by keyed state: equal to the batch alerts, found while the stream runs, over restarts."""

from pyspark.sql import functions as F

import eventflow as ef
from eventflow.streaming import keyed_alert_stream

COLUMNS = ["tenant_id", "dataset_id", "alert_time", "recent_samples", "recent_failures", "severity"]
DAY = 1 << 40


def results(spark, n):
    """One dataset holds most of the rows, one has no name; the failure share drifts."""
    return spark.range(n).selectExpr(
        "id",
        "timestamp_micros(1700000000000000 + id * 20000000 + (id * 7919) % 13000000) AS at",
        "'t' AS tenant_id",
        "CASE WHEN id % 10 < 8 THEN 'big' WHEN id % 7 > 0 THEN concat('d', id % 7) END AS dataset_id",
        "pmod(hash(id), 100) < 10 + 30 * (id div 500 % 2) AS failed",
        "false AS beat",
    )


def test_alerts_of_keyed_state_equal_batch(spark, tmp_path):
    df = results(spark, 1200)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    # batches end inside checks, and rows of a batch may belong up to 17 minutes before its start
    cuts = [1700000000, 1700006333, 1700012777, 1700019000]
    part_of = F.unix_seconds("at") + (F.col("id") % 7) * 170
    found = []
    for i, (low, high) in enumerate(zip(cuts, [*cuts[1:], DAY])):
        part = df.where((part_of > low) & (part_of <= high) | (F.lit(i == 0) & (part_of <= low)))
        part.coalesce(1).write.mode("append").parquet(source)
        if i == len(cuts) - 1:  # a row that only moves the time closes the last checks
            clock = spark.range(1).selectExpr("id", "timestamp_seconds(1800000000) AS at", "'t' AS tenant_id", "'x' AS dataset_id", "true AS failed", "true AS beat")
            clock.write.mode("append").parquet(source)
        # each round starts the query again on its checkpoint
        stream = spark.readStream.schema(df.schema).parquet(source)
        run = keyed_alert_stream(
            stream, path=out, checkpoint=checkpoint, failed="failed", time_column="at", order_by=("at", "id"),
            delay_seconds=1200, slices=3, heartbeat=F.col("beat"),
        )
        run.awaitTermination()
        assert run.exception() is None
        found.append(spark.read.parquet(out).count())
    got = sorted(map(str, map(tuple, spark.read.parquet(out).select(COLUMNS).collect())))
    batch = ef.failure_alerts(ef.failure_rate(df, "failed", ("at", "id")), "at", ("at", "id"))
    assert got == sorted(map(str, map(tuple, batch.select(COLUMNS).collect())))
    # checks close during the run, not at its end
    assert 0 < found[1] < found[2] < found[-1] == len(got)
