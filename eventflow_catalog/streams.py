"""Streams over the event files, run until the input is used up."""

from pyspark.sql import functions as F

import eventflow as ef
from eventflow.streaming import (
    alert_stream,
    committed,
    finish_alerts,
    keyed_alert_stream,
    metrics_stream,
    publish,
    refreshing_stream,
    route_errors_stream,
    run_stream,
    versioned_stream,
)
from eventflow.streaming.runner import latest_metrics

from .base import EVENTS, query, table
from .lookups import AGENT
from .summaries import ALERTS
from .transfer import COLUMNS, SCHEMA


# Events of an arriving file at most.  One task reads a gzip file, so files and the tasks of a batch grow in number, not in size.
FILE_EVENTS = 50_000


def _files(events: int, least: int) -> int:
    return max(least, -(-events // FILE_EVENTS))


def _stream(spark, sf):
    """Events as a stream of JSON-line files in time order of arrival, half of them a batch."""
    source = ef.scratch_dir(spark, "arriving")
    df = table(spark, sf, "events")
    files = _files(df.count(), 4)
    extra = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    lines = df.repartitionByRange(files, "ts", "event_id").select(F.to_json(F.struct(*COLUMNS, extra)).alias("value"))
    lines.write.option("compression", "gzip").text(source)
    stream = ef.read_events_stream(spark, source, SCHEMA + ", at string", max_files=-(-files // 2))
    return stream.withColumns(
        {
            "tenant_id": F.expr("concat('t', user_id % 3)"),
            "dataset_id": F.col("event_type"),
            "at": F.to_timestamp("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        }
    )


SPEC = [
    {"type": "conditional", "config": {"field": "value", "operator": "gte", "value": 50}},
    {"type": "enricher", "config": {"enricher_id": "c", "source_field": "user_id", "target_field": "c", "index_column": "c_custkey"}},
    {"type": "add_field", "config": {"field": "path", "value": "${tenant_id}/${dataset_id}"}},
]


@query(
    "stream_chain",
    f"""SELECT event_id, tenant_id || '/' || dataset_id AS path, c_name AS name FROM {EVENTS}
        LEFT JOIN customer ON c_custkey = user_id WHERE value >= 50""",
)
def _(spark, sf):
    out, checkpoint = ef.scratch_dir(spark, "chain"), ef.scratch_dir(spark, "checkpoint")
    run = run_stream(_stream(spark, sf), SPEC, out, checkpoint, tables={"c": table(spark, sf, "customer")})
    run.awaitTermination()
    back = ef.read_events(spark, out, "event_id bigint, path string, c struct<c_name:string>")
    return back.select("event_id", "path", F.col("c.c_name").alias("name"))


@query(
    "stream_chain_micro_batch",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Windows' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Android' ELSE 'Other' END AS os FROM events",
)
def _(spark, sf):
    out, checkpoint = ef.scratch_dir(spark, "agents"), ef.scratch_dir(spark, "checkpoint")
    stream = _stream(spark, sf).withColumn("user_agent", F.expr(AGENT))
    run = run_stream(stream, [{"type": "useragent", "config": {"distinct": True}}], out, checkpoint, partition_by=(), batches=True)
    run.awaitTermination()
    return ef.read_events(spark, out, "event_id bigint, ua struct<os:string>").select("event_id", "ua.os")


@query(
    "stream_dataset_metrics",
    f"""SELECT tenant_id, dataset_id, count(*) AS total_processed, count(*) FILTER (value >= 10) AS success_count,
        count(*) FILTER (value < 10) AS error_count, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_processed
        FROM {EVENTS} GROUP BY 1, 2""",
)
def _(spark, sf):
    out, checkpoint = ef.scratch_dir(spark, "metrics"), ef.scratch_dir(spark, "checkpoint")
    stream = _stream(spark, sf).withColumn("_error", F.when(F.col("value") < 10, "low"))
    metrics_stream(stream, out, checkpoint, "at").awaitTermination()
    latest = latest_metrics(spark.read.parquet(out))
    return latest.select(
        "tenant_id",
        "dataset_id",
        "total_processed",
        "success_count",
        "error_count",
        F.date_format("last_processed", "yyyy-MM-dd'T'HH:mm:ss").alias("last_processed"),
    )


# Days of a slice of the event files that arrive one after the other; each slice has as many files, two at least, and is a batch.
SLICE_DAYS = 5
DAYS = 30


class _Arriving:
    """Event files written slice by slice in time order, so that a stream picks them up in that order."""

    def __init__(self, spark, sf):
        self.spark, self.source = spark, ef.scratch_dir(spark, "arriving")
        self.events = table(spark, sf, "events").withColumn("day", F.expr("datediff(ts, DATE'2024-01-01')"))
        self.slices = DAYS // SLICE_DAYS
        self.files = _files(self.events.count() // self.slices, 2)

    def _append(self, df, files):
        extra = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
        lines = df.repartition(files).select(F.to_json(F.struct(*COLUMNS, extra)).alias("value"))
        lines.write.mode("append").option("compression", "gzip").text(self.source)

    def write(self, first, last):
        for i in range(first, last):
            # the outer slices take what is before or after all days
            low = F.col("day") >= i * SLICE_DAYS if i else F.lit(True)
            high = F.col("day") < (i + 1) * SLICE_DAYS if i < self.slices - 1 else F.lit(True)
            self._append(self.events.where(low & high), self.files)

    def tick(self):
        """A row that only moves the time, two days after the last event."""
        last = self.events.agg(F.max(F.struct("ts", *COLUMNS)).alias("e")).select("e.*")
        later = last.withColumns({"ts": F.expr("ts + INTERVAL 2 DAYS"), "event_type": F.lit("tick")})
        self._append(later, 1)

    def stream(self):
        read = ef.read_events_stream(self.spark, self.source, SCHEMA + ", at string", max_files=self.files)
        return read.withColumns(
            {
                "tenant_id": F.expr("concat('t', user_id % 3)"),
                "dataset_id": F.expr("concat('d', user_id % 2)"),
                "at": F.to_timestamp("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                "failed": F.col("event_type") == "error",
            }
        )


# Results may come so late; checks close three checks behind the stream.
DELAY_SECONDS = 900


@query("stream_failure_alerts", ALERTS)
def _(spark, sf):
    out, state, checkpoint = (ef.scratch_dir(spark, n) for n in ("alerts", "state", "checkpoint"))
    arriving = _Arriving(spark, sf)
    arriving.write(0, arriving.slices)
    run = alert_stream(arriving.stream(), "failed", "at", ("at", "event_id"), out, state, checkpoint, delay_seconds=DELAY_SECONDS)
    run.awaitTermination()
    finish_alerts(spark, run.lastProgress["batchId"], out, state, ("at", "event_id"))
    alerts = spark.read.parquet(out).drop("batch")
    return alerts.withColumn("alert_time", F.date_format("alert_time", "yyyy-MM-dd'T'HH:mm:ss"))


@query("stream_failure_alerts_keyed", ALERTS)
def _(spark, sf):
    out, checkpoint = ef.scratch_dir(spark, "alerts"), ef.scratch_dir(spark, "checkpoint")
    arriving = _Arriving(spark, sf)
    half = arriving.slices // 2
    for first, last in ((0, half), (half, arriving.slices)):
        arriving.write(first, last)
        if last == arriving.slices:
            arriving.tick()
        # the second run goes on from the first one's checkpoint
        run = keyed_alert_stream(
            arriving.stream(), path=out, checkpoint=checkpoint, failed="failed", time_column="at", order_by=("at", "event_id"),
            delay_seconds=DELAY_SECONDS, slices=4, heartbeat=F.col("event_type") == "tick",
        )
        run.awaitTermination()
    alerts = spark.read.parquet(out)
    return alerts.withColumn("alert_time", F.date_format("alert_time", "yyyy-MM-dd'T'HH:mm:ss"))


@query(
    "stream_refreshed_lookups",
    "SELECT event_id, c_name AS name FROM events JOIN customer ON c_custkey = user_id WHERE event_type <> 'view'",
)
def _(spark, sf):
    out, checkpoint, config = (ef.scratch_dir(spark, n) for n in ("refreshed", "checkpoint", "spec"))
    rows = [("exclude", '{"field": "event_type", "equals": "view"}'),
            ("enricher", '{"enricher_id": "c", "source_field": "user_id", "target_field": "c", "index_column": "c_custkey"}')]
    spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos int, type string, config string").write.parquet(config)

    def load_spec():
        import json

        steps = spark.read.parquet(config).orderBy("pos").collect()
        return [{"type": s["type"], "config": json.loads(s["config"])} for s in steps]

    run = refreshing_stream(
        _stream(spark, sf), load_spec, lambda: {"c": table(spark, sf, "customer")}, out, checkpoint, partition_by=()
    )
    run.awaitTermination()
    back = ef.read_events(spark, out, "event_id bigint, c struct<c_name:string>")
    return back.select("event_id", F.col("c.c_name").alias("name"))


@query(
    "stream_dataset_metrics_full",
    f"""SELECT tenant_id, dataset_id, count(*) AS total_processed, count(*) FILTER (value >= 20) AS success_count,
        count(*) FILTER (value < 10) AS error_count, count(*) FILTER (value >= 10 AND value < 20) AS skipped_count,
        arg_max('low ' || event_id, ts) FILTER (value < 10) AS last_error, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_processed,
        count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) AS avg_rows_per_sec FROM {EVENTS} GROUP BY 1, 2""",
)
def _(spark, sf):
    out, checkpoint = ef.scratch_dir(spark, "metrics"), ef.scratch_dir(spark, "checkpoint")
    stream = _stream(spark, sf).withColumns(
        {"_error": F.when(F.col("value") < 10, F.concat(F.lit("low "), "event_id")), "_skipped": F.col("value") < 20}
    )
    metrics_stream(stream, out, checkpoint, "at").awaitTermination()
    latest = latest_metrics(spark.read.parquet(out))
    return latest.withColumn("last_processed", F.date_format("last_processed", "yyyy-MM-dd'T'HH:mm:ss"))


@query(
    "stream_dead_letters",
    """SELECT 'good' AS side, event_type AS kind, count(*) AS n FROM events GROUP BY ALL
        UNION ALL SELECT 'dead', 'line is not a JSON object', count(*) FROM events WHERE event_id % 50 = 3""",
)
def _(spark, sf):
    source, out, checkpoint = (ef.scratch_dir(spark, n) for n in ("arriving", "sides", "checkpoint"))
    df = table(spark, sf, "events")
    line = F.to_json(F.struct(*COLUMNS))
    lines = df.select("event_id", F.explode(F.when(F.col("event_id") % 50 == 3, F.array(line, F.lit("broken"))).otherwise(F.array(line))).alias("value"))
    for half in (0, 1):
        lines.where(F.col("event_id") % 2 == half).select("value").write.mode("append").option("compression", "gzip").text(source)
        # the second run goes on from the first one's checkpoint
        route_errors_stream(ef.read_events_stream(spark, source, SCHEMA), out, checkpoint, partition_by=()).awaitTermination()
    good, dead = committed(spark, out)
    kept = ef.read_events(spark, good, SCHEMA).select(F.lit("good").alias("side"), F.col("event_type").alias("kind"))
    lost = spark.read.parquet(*dead).select(F.lit("dead").alias("side"), F.col("_error").alias("kind"))
    return kept.unionByName(lost).groupBy("side", "kind").agg(F.count("*").alias("n"))


@query(
    "stream_versioned_lookups",
    """SELECT event_id, CASE event_id % 2 WHEN 0 THEN 'first' ELSE 'second' END AS mark,
       CASE event_id % 2 WHEN 0 THEN c_name ELSE c_mktsegment END AS found, n_name AS nation
       FROM events JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = user_id % 30""",
)
def _(spark, sf):
    store, source, out, checkpoint = (ef.scratch_dir(spark, n) for n in ("store", "arriving", "versioned", "checkpoint"))
    customers, nations = table(spark, sf, "customer"), table(spark, sf, "nation")
    look_up = lambda name, source, index: {
        "type": "enricher", "config": {"enricher_id": name, "source_field": source, "target_field": name, "index_column": index}
    }
    events_of = table(spark, sf, "events").join(customers, F.col("c_custkey") == F.col("user_id"), "left_semi")
    for half, mark, value in ((0, "first", "c_name"), (1, "second", "c_mktsegment")):
        rows = events_of.where(F.col("event_id") % 2 == half).select(F.to_json(F.struct(*COLUMNS, F.expr("user_id % 30 AS n"))).alias("value"))
        rows.write.mode("append").option("compression", "gzip").text(source)
        spec = [{"type": "add_field", "config": {"field": "mark", "value": mark}}, look_up("c", "user_id", "c_custkey"), look_up("n", "n", "n_nationkey")]
        # the nations stay as they are, and with them their files
        publish(spark, store, spec, {"c": customers.select("c_custkey", F.col(value).alias("found")), "n": nations.select("n_nationkey", "n_name")})
        stream = ef.read_events_stream(spark, source, SCHEMA + ", n bigint")
        versioned_stream(stream, store, out, checkpoint, partition_by=()).awaitTermination()
    back = ef.read_events(spark, out, "event_id bigint, mark string, c struct<found:string>, n struct<n_name:string>")
    return back.select("event_id", "mark", F.col("c.found").alias("found"), F.col("n.n_name").alias("nation"))
