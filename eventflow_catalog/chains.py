"""Whole filter chains."""

from pyspark.sql import functions as F

import eventflow as ef

from .base import EVENTS, events, query, table

FLAGSHIP = [
    {"type": "conditional", "config": {"field": "value", "operator": "gte", "value": 20}, "enabled": True},
    {"type": "json_flatten", "config": {"source_field": "props", "target_field": "flat"}, "enabled": True},
    {"type": "unflatten_k", "config": {"from": "flat", "key": "k"}, "enabled": True},
    {"type": "mutate", "config": {"convert": {"k": "integer"}, "remove": ["props"]}, "enabled": True},
    {"type": "date_parse", "config": {"source_field": "time", "formats": ["2006-01-02 15:04:05"]}, "enabled": True},
    {"type": "drop", "config": {"always_drop": True}, "enabled": False},
    {
        "type": "enricher",
        "config": {"enricher_id": "customers", "source_field": "user_id", "target_field": "customer", "index_column": "c_custkey"},
        "enabled": True,
    },
    {"type": "fingerprint", "config": {"source_fields": ["user_id", "event_type", "k"]}, "enabled": True},
]


def _take_key(df, config):
    """Custom step: one member of a flattened map as a text column."""
    return df.withColumn(config["key"], F.col(config["from"])[config["key"]].cast("string")).drop(config["from"])


def flagship_rows(spark, sf):
    ef.register_filter("unflatten_k", _take_key)
    df = events(spark, sf).withColumn("time", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return ef.run_pipeline(df, {"filters": FLAGSHIP}, tables={"customers": table(spark, sf, "customer")})


def flagship(spark, sf):
    rows = flagship_rows(spark, sf).withColumn("_error", F.when(F.col("event_type") == "error", F.col("fingerprint")))
    out = ef.dataset_metrics(rows, time_column="@timestamp")
    return out.select("tenant_id", "dataset_id", "total_processed", "success_count", "error_count", "last_error", "last_processed")


@query(
    "filter_chain",
    f"""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS "@timestamp", c_name AS customer,
        sha256(user_id || '|' || event_type || '|' || json_extract_string(props, '$.k')) AS fingerprint
        FROM {EVENTS} LEFT JOIN customer ON c_custkey = user_id WHERE value >= 20""",
)
def _(spark, sf):
    out = flagship_rows(spark, sf)
    return out.select("event_id", "k", "@timestamp", F.col("customer.c_name").alias("customer"), "fingerprint")


@query(
    "chain_dataset_metrics",
    f"""SELECT tenant_id, dataset_id, count(*) AS total_processed, count(*) FILTER (event_type <> 'error') AS success_count,
        count(*) FILTER (event_type = 'error') AS error_count,
        arg_max(sha256(user_id || '|' || event_type || '|' || json_extract_string(props, '$.k')), ts) FILTER (event_type = 'error') AS last_error,
        strftime(max(ts), '%Y-%m-%dT%H:%M:%S') || 'Z' AS last_processed
        FROM {EVENTS} WHERE value >= 20 GROUP BY 1, 2""",
)
def _(spark, sf):
    return flagship(spark, sf)


@query(
    "chain_include_add_flatten",
    """SELECT event_id, 'true' AS processed, value AS "data.cpu", user_id AS "data.mem", event_type AS host
       FROM events WHERE regexp_matches(event_type, 'ck$')""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("host"),
        F.struct(F.col("value").alias("cpu"), F.col("user_id").alias("mem")).alias("data"),
    )
    spec = [
        {"type": "include", "config": {"field": "host", "matches": "ck$"}},
        {"type": "add_field", "config": {"field": "processed", "value": "true"}},
        {"type": "json_flatten", "config": {"separator": "."}},
    ]
    return ef.run_pipeline(df, spec)


@query(
    "chain_default",
    f"""SELECT event_id, 'eventflow' AS processed_by, 'default-1.0' AS pipeline_version FROM {EVENTS}""",
)
def _(spark, sf):
    return ef.run_pipeline(events(spark, sf), None).select("event_id", "processed_by", "pipeline_version")


@query("chain_disabled", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    spec = {"enabled": False, "filters": [{"type": "drop", "config": {"always_drop": True}}]}
    return ef.run_pipeline(table(spark, sf, "events"), spec).select("event_id", "event_type")


@query(
    "chain_conditions",
    """SELECT event_id, CASE WHEN user_id < 50 THEN upper(event_type) ELSE event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN 'yes' END AS failed FROM events WHERE NOT (event_type = 'view' AND user_id >= 100)""",
)
def _(spark, sf):
    spec = [
        {"type": "add_field", "condition": "event_type = 'error'", "config": {"field": "failed", "value": "yes"}},
        {"type": "drop", "condition": "user_id >= 100", "config": {"if_field": "event_type", "equals": "view"}},
        {"type": "mutate", "condition": "user_id < 50", "config": {"uppercase": ["event_type"]}},
    ]
    return ef.run_pipeline(table(spark, sf, "events"), spec).select("event_id", "event_type", "failed")


@query(
    "chain_decode_errors",
    """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'x' END AS mark FROM events WHERE event_id % 10 = 0 OR event_type = 'view'""",
)
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("_error", F.when(F.col("event_id") % 10 == 0, "bad"))
    spec = [
        {"type": "include", "config": {"field": "event_type", "equals": "view"}},
        {"type": "add_field", "config": {"field": "mark", "value": "x"}},
    ]
    return ef.run_pipeline(df, spec).select("event_id", "mark")


@query(
    "chain_audited",
    """SELECT event_id, value < 10 OR event_type = 'view' AS _skipped,
       CASE WHEN value < 10 THEN 'conditional' WHEN event_type = 'view' THEN 'conditional,add_field,exclude'
            WHEN user_id < 50 THEN 'conditional,add_field,fingerprint' ELSE 'conditional,add_field' END AS applied,
       CASE WHEN value < 10 THEN 'conditional' WHEN event_type = 'view' THEN 'exclude' END AS _skipped_by,
       CASE WHEN value >= 10 THEN 'a' END AS mark,
       CASE WHEN value >= 10 AND event_type <> 'view' AND user_id < 50 THEN md5('n') END AS print,
       event_type AS input_type FROM events""",
)
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("note", F.when(F.col("user_id") < 50, "n"))
    spec = [
        {"type": "conditional", "config": {"field": "value", "operator": "gte", "value": 10}},
        {"type": "add_field", "config": {"field": "mark", "value": "a"}},
        {"type": "exclude", "config": {"field": "event_type", "equals": "view"}},
        {"type": "fingerprint", "config": {"source_fields": ["note"], "method": "MD5", "target_field": "print"}},
        {"type": "remove_field", "enabled": False, "config": {"field": "event_type"}},
    ]
    out = ef.run_pipeline_audited(df, spec)
    return out.select(
        "event_id",
        "_skipped",
        F.array_join("_applied", ",").alias("applied"),
        "_skipped_by",
        F.get_json_object("_output", "$.mark").alias("mark"),
        F.get_json_object("_output", "$.print").alias("print"),
        F.get_json_object("_input", "$.event_type").alias("input_type"),
    )


@query(
    "chain_custom_steps",
    "SELECT event_id, user_id * 2 AS doubled, reverse(event_type) AS backwards FROM events WHERE event_id % 2 = 0",
)
def _(spark, sf):
    ef.register_filter("double_user", lambda df, config: df.withColumn("doubled", F.col(config["field"]) * 2).where("event_id % 2 = 0"))
    ef.register_parser("reverse", lambda value, settings: F.struct(F.reverse(value).alias("backwards")))
    spec = [
        {"type": "double_user", "config": {"field": "user_id"}},
        {"type": "parse", "config": {"parser_name": "reverse", "source_field": "event_type"}},
    ]
    return ef.run_pipeline(table(spark, sf, "events"), spec).select("event_id", "doubled", "backwards")
