"""Schemas, metrics and alerts."""

from pyspark.sql import functions as F

import eventflow as ef

from .base import EVENTS, events, query, table

# Records whose members come and go, with a member of two types.
RECORD = """CASE event_id % 3 WHEN 0 THEN props
    WHEN 1 THEN concat('{"k":"', event_type, '","list":[1],"_hidden":1}')
    ELSE concat('{"k":null,"deep":{"x":true},"flag":', event_id % 2 = 0, '}') END"""


def _records(spark, sf):
    return table(spark, sf, "events").select("event_id", F.expr(RECORD).alias("record"))


@query(
    "schema_union",
    """SELECT field, types, (SELECT count(*) FROM events) AS sample_count FROM
       (VALUES ('k', 'null,number,string'), ('list', 'array'), ('deep', 'object'), ('flag', 'boolean')) v(field, types)""",
)
def _(spark, sf):
    out = ef.schema_union(_records(spark, sf), record="record")
    return out.select("field", F.array_join("types", ",").alias("types"), "sample_count")


@query(
    "schema_union_columns",
    """SELECT field, types, (SELECT count(*) FROM orders) AS sample_count FROM
       (VALUES ('o_orderkey', 'number'), ('o_custkey', 'number'), ('o_orderstatus', 'string'),
        ('o_totalprice', 'number'), ('o_orderdate', 'string'), ('o_orderpriority', 'string')) v(field, types)""",
)
def _(spark, sf):
    out = ef.schema_union(table(spark, sf, "orders"))
    return out.select("field", F.array_join("types", ",").alias("types"), "sample_count")


@query(
    "schema_profile",
    """WITH c AS (SELECT count(*) FILTER (event_id % 3 = 0) AS zero, count(*) FILTER (event_id % 3 = 1) AS one,
       count(*) FILTER (event_id % 3 = 2) AS two FROM events)
       SELECT 'k' AS field, CASE WHEN two >= greatest(zero, one) THEN 'null' WHEN zero >= one THEN 'number' ELSE 'string' END AS type,
       zero + one + two AS count, FALSE AS nullable,
       (SELECT json_extract_string(props, '$.k') FROM events WHERE event_id = 0) AS sample FROM c
       UNION ALL SELECT 'list', 'array', one, TRUE, '[1]' FROM c
       UNION ALL SELECT 'deep', 'object', two, TRUE, '{"x":true}' FROM c
       UNION ALL SELECT 'flag', 'boolean', two, TRUE, 'true' FROM c""",
)
def _(spark, sf):
    return ef.schema_profile(_records(spark, sf), order_by="event_id", record="record")


def _marked(spark, sf):
    return events(spark, sf).withColumns(
        {
            "_error": F.when(F.col("event_type") == "error", F.concat(F.lit("failed "), "event_id")),
            "_skipped": F.col("value") < 10,
            "dataset_id": F.expr("concat('d', user_id % 2)"),
        }
    )


@query(
    "dataset_metrics",
    f"""SELECT tenant_id, 'd' || (user_id % 2) AS dataset_id, count(*) AS total_processed,
        count(*) FILTER (event_type <> 'error' AND value >= 10) AS success_count,
        count(*) FILTER (event_type = 'error') AS error_count,
        count(*) FILTER (event_type <> 'error' AND value < 10) AS skipped_count,
        'failed ' || arg_max(event_id, ts) FILTER (event_type = 'error') AS last_error,
        strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_processed,
        round(count(*) / (epoch_us(max(ts)) - epoch_us(min(ts))) * 1e6, 9) AS avg_rows_per_sec FROM {EVENTS} GROUP BY 1, 2""",
)
def _(spark, sf):
    out = ef.dataset_metrics(_marked(spark, sf), time_column="ts")
    return out.withColumns(
        {
            "last_processed": F.date_format("last_processed", "yyyy-MM-dd'T'HH:mm:ss"),
            "avg_rows_per_sec": F.round("avg_rows_per_sec", 9),
        }
    )


RULES = [
    {"type": "conditional", "config": {"field": "value", "operator": "gte", "value": 10}},
    {"type": "include", "config": {"any_field": ["event_type"], "any_matches": "[cr]"}},
    {"type": "add_field", "config": {"field": "checked", "value": "yes"}},
    {"type": "mutate", "config": {"update": {"note": "x"}}},
]


def _audited(spark, sf):
    df = events(spark, sf).withColumns(
        {
            "note": F.when(F.col("user_id") < 50, "n"),
            "_error": F.when(F.col("event_id") % 50 == 0, F.lit("line is not a JSON object")),
        }
    )
    return ef.run_pipeline_audited(df, RULES)


@query(
    "transformation_summary",
    """SELECT count(*) FILTER (event_id % 50 <> 0 AND value >= 10 AND regexp_matches(event_type, '[cr]')) AS success_count,
       count(*) FILTER (event_id % 50 = 0) AS error_count,
       count(*) FILTER (event_id % 50 <> 0 AND NOT (value >= 10 AND regexp_matches(event_type, '[cr]'))) AS skipped_count
       FROM events""",
)
def _(spark, sf):
    return ef.transformation_summary(_audited(spark, sf))


@query(
    "filter_stats",
    """WITH e AS (SELECT *, value >= 10 AS a, regexp_matches(event_type, '[cr]') AS b FROM events WHERE event_id % 50 <> 0)
       SELECT 'conditional' AS filter, count(*) AS applied_count, count(*) FILTER (NOT a) AS skipped_count, 0::BIGINT AS error_count FROM e
       UNION ALL SELECT 'include', count(*) FILTER (a), count(*) FILTER (a AND NOT b), 0 FROM e
       UNION ALL SELECT 'add_field', count(*) FILTER (a AND b), 0, 0 FROM e
       UNION ALL SELECT 'mutate', count(*) FILTER (a AND b AND user_id < 50), 0, 0 FROM e
       UNION ALL SELECT 'decode', 0, 0, count(*) FROM events WHERE event_id % 50 = 0""",
)
def _(spark, sf):
    return ef.filter_stats(_audited(spark, sf))


@query(
    "processing_stats",
    f"""SELECT tenant_id, count(*) AS input_records, count(*) FILTER (event_type <> 'error' AND value >= 10) AS output_records,
        count(*) FILTER (event_type <> 'error' AND value < 10) AS filtered_records,
        count(*) FILTER (event_type = 'error') AS error_records,
        CAST(sum(strlen(props) + 1) AS BIGINT) AS input_size_bytes,
        CAST(sum(strlen(event_type) + 1) FILTER (value >= 10 OR event_type = 'error') AS BIGINT) AS output_size_bytes FROM {EVENTS} GROUP BY 1""",
)
def _(spark, sf):
    return ef.processing_stats(_marked(spark, sf), ["tenant_id"], "props", "event_type")


RATES = """(SELECT event_id, ts, 't' || (user_id % 3) AS tenant_id, 'd' || (user_id % 2) AS dataset_id,
    count(*) OVER w AS recent_samples, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS recent_failures,
    CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w AS DOUBLE) * 100 / count(*) OVER w AS failure_rate
    FROM events WINDOW w AS (PARTITION BY user_id % 3, user_id % 2 ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))"""


def _rates(spark, sf):
    df = events(spark, sf).select(
        "event_id",
        "ts",
        "tenant_id",
        F.expr("concat('d', user_id % 2)").alias("dataset_id"),
        (F.col("event_type") == "error").alias("failed"),
    )
    return ef.failure_rate(df, "failed", ("ts", "event_id"), next_of="ts")


@query(
    "failure_rate",
    f"SELECT event_id, tenant_id, dataset_id, recent_samples, recent_failures, failure_rate FROM {RATES}",
)
def _(spark, sf):
    names = ["event_id", "tenant_id", "dataset_id", "recent_samples", "recent_failures", "failure_rate"]
    return _rates(spark, sf).select(names)


ALERTS = f"""WITH RECURSIVE checks AS MATERIALIZED (
      SELECT tenant_id, dataset_id, CAST(ceil(epoch_us(ts) / 3e8) AS BIGINT) * 300 AS c,
             arg_max(struct_pack(n := recent_samples, f := recent_failures, r := failure_rate), struct_pack(t := ts, e := event_id)) AS s
      FROM {RATES} GROUP BY ALL),
    breaches AS MATERIALIZED (SELECT tenant_id, dataset_id, c, s.n AS n, s.f AS f, s.r AS r FROM checks WHERE s.r >= 20 AND s.n >= 10),
    next AS MATERIALIZED (SELECT a.tenant_id, a.dataset_id, a.c, b.c AS c2 FROM breaches a ASOF JOIN breaches b
             ON a.tenant_id = b.tenant_id AND a.dataset_id = b.dataset_id AND a.c + 1800 <= b.c),
    fired AS (SELECT tenant_id, dataset_id, min(c) AS c FROM breaches GROUP BY ALL
              UNION ALL SELECT n.tenant_id, n.dataset_id, n.c2 FROM fired
              JOIN next n ON n.tenant_id = fired.tenant_id AND n.dataset_id = fired.dataset_id AND n.c = fired.c)
    SELECT tenant_id, dataset_id, strftime(make_timestamp(c * 1000000), '%Y-%m-%dT%H:%M:%S') AS alert_time, n AS recent_samples,
           f AS recent_failures, r AS failure_rate, CASE WHEN r >= 40 THEN 'critical' WHEN r >= 30 THEN 'high' ELSE 'medium' END AS severity
    FROM fired JOIN breaches USING (tenant_id, dataset_id, c)"""


@query("failure_alerts", ALERTS)
def _(spark, sf):
    alerts = ef.failure_alerts(_rates(spark, sf), "ts", ("ts", "event_id"))
    return alerts.withColumn("alert_time", F.date_format("alert_time", "yyyy-MM-dd'T'HH:mm:ss"))
