"""Steps that change the number of rows."""

from pyspark.sql import functions as F

import eventflow as ef

from .base import EVENTS, events, query, table


@query(
    "split_text",
    """SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part WHERE p_partkey % 5 <> 0
       UNION ALL SELECT p_partkey, p_name FROM part WHERE p_partkey % 5 = 0""",
)
def _(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey",
        F.expr("if(p_partkey % 5 = 0, p_name, replace(p_name, ' ', ' ; '))").alias("word"),
    )
    return ef.split(df, field="word", terminator=";")


@query(
    "split_array",
    "SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS item FROM embeddings",
)
def _(spark, sf):
    out = ef.split(table(spark, sf, "embeddings"), field="embedding", target="item")
    return out.select("vec_id", F.col("item").cast("double").alias("item"))


@query(
    "split_metadata",
    """SELECT p_partkey, 'p_name' AS _split_field, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS _split_count,
       string_split(p_name, ' ')[1] AS first FROM part""",
)
def _(spark, sf):
    out = ef.split(table(spark, sf, "part"), field="p_name", terminator=" ", emit="metadata")
    return out.select(
        "p_partkey",
        "_split_field",
        F.col("_split_count").cast("bigint").alias("_split_count"),
        F.col("_split_items")[0].alias("first"),
    )


@query("head_sample", "SELECT event_id, user_id, event_type, value FROM events ORDER BY ts, event_id LIMIT 10")
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("_internal", F.lit(1)).drop("props")
    return ef.head_sample(df, ["ts", "event_id"], 10).drop("ts")


ROUTED = f"""SELECT event_id, tenant_id, dataset_id, CASE WHEN dataset_id IN ('click', 'view') THEN 'seen' END AS mark,
        CASE WHEN dataset_id = 'error' THEN upper(event_type) ELSE event_type END AS event_type,
        CASE WHEN dataset_id NOT IN ('click', 'view', 'error') THEN 'eventflow' END AS processed_by
        FROM {EVENTS} WHERE NOT (dataset_id = 'error' AND user_id < 50)"""


def _specs():
    seen = [{"type": "add_field", "config": {"field": "mark", "value": "seen"}}]
    errors = [
        {"type": "conditional", "config": {"field": "user_id", "operator": "gte", "value": 50}},
        {"type": "mutate", "config": {"uppercase": ["event_type"]}},
    ]
    specs = {}
    for tenant in ("t0", "t1", "t2"):
        specs[tenant, "click"] = seen
        specs[tenant, "view"] = seen
        specs[tenant, "error"] = errors
    return specs


@query("route_by_dataset", ROUTED)
def _(spark, sf):
    out = ef.route(events(spark, sf), _specs())
    return out.select("event_id", "tenant_id", "dataset_id", "mark", "event_type", "processed_by")


@query("route_one_scan", ROUTED)
def _(spark, sf):
    out = ef.route_once(events(spark, sf), _specs())
    return out.select("event_id", "tenant_id", "dataset_id", "mark", "event_type", "processed_by")
