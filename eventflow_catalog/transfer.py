"""Readers and writers: each query writes the events with the library or Spark and reads them back."""

from pyspark.sql import functions as F

import eventflow as ef
from eventflow.sources.events import decode_lines

from .base import EVENTS, events, query, table

SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, props string"
COLUMNS = ["event_id", "user_id", "event_type", "value", "props"]


def written(spark, sf) -> str:
    """Folder of gzip JSON lines by tenant and dataset, with blank and broken lines among them."""
    path = ef.scratch_dir(spark, "lines")
    df = events(spark, sf)
    line = F.to_json(F.struct(*COLUMNS))
    broken = F.when(F.col("event_id") % 100 == 7, F.array(line, F.lit("  "), F.expr("concat('broken ', event_id)")))
    lines = df.select("tenant_id", "dataset_id", F.explode(F.coalesce(broken, F.array(line))).alias("value"))
    lines.write.partitionBy("tenant_id", "dataset_id").option("compression", "gzip").text(path)
    return path


BROKEN = "SELECT NULL, NULL, NULL, NULL, NULL, 'broken ' || event_id FROM events WHERE event_id % 100 = 7"


@query("read_events", f"SELECT event_id, user_id, event_type, value, props, NULL AS _raw FROM events UNION ALL {BROKEN}")
def _(spark, sf):
    return ef.read_events(spark, written(spark, sf), SCHEMA).select(*COLUMNS, "_raw")


@query(
    "read_events_variant",
    """SELECT event_id, event_type, FALSE AS bad FROM events
       UNION ALL SELECT NULL, NULL, TRUE FROM events WHERE event_id % 100 = 7""",
)
def _(spark, sf):
    df = ef.read_events(spark, written(spark, sf))
    return df.select(
        F.try_variant_get("record", "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get("record", "$.event_type", "string").alias("event_type"),
        F.col("_error").isNotNull().alias("bad"),
    )


@query("read_events_stream", "SELECT event_id, user_id, event_type, value, props FROM events")
def _(spark, sf):
    source = written(spark, sf)
    out, checkpoint = ef.scratch_dir(spark, "copy"), ef.scratch_dir(spark, "checkpoint")
    stream = ef.read_events_stream(spark, source, SCHEMA, max_files=20)
    good, _ = ef.split_errors(stream)
    run = ef.write_events_stream(good, out, checkpoint, partition_by=())
    run.awaitTermination()
    return ef.read_events(spark, out, SCHEMA).select(COLUMNS)


KEYS = """CASE event_id % 5
    WHEN 0 THEN concat('raw/tenant=', tenant_id, '/dataset=', dataset_id, '/year=', year(ts), '/month=', lpad(month(ts), 2, '0'), '/day=', lpad(day(ts), 2, '0'), '/hour=', lpad(hour(ts), 2, '0'), '/f', event_id, '.ndjson.gz')
    WHEN 1 THEN concat(tenant_id, '/', dataset_id, '/f', event_id, '.gz')
    WHEN 2 THEN concat(tenant_id, '/', dataset_id, '/other--names--', event_id, '--ndjson.gz')
    WHEN 3 THEN concat(tenant_id, '--', dataset_id, '--', event_id, '--ndjson.gz')
    ELSE concat('file', event_id, '.gz') END"""


def keys(spark, sf):
    return events(spark, sf).select("event_id", F.expr(KEYS).alias("path"))


@query(
    "path_metadata",
    f"""SELECT event_id, tenant_id, dataset_id, CASE WHEN event_id % 5 = 0 THEN strftime(ts, '%Y%m%d%H') END AS hour_of,
        CASE event_id % 5 WHEN 0 THEN 'f' || event_id || '.ndjson.gz' WHEN 1 THEN 'f' || event_id || '.gz'
             WHEN 2 THEN 'other--names--' || event_id || '--ndjson.gz'
             ELSE tenant_id || '--' || dataset_id || '--' || event_id || '--ndjson.gz' END AS filename
        FROM {EVENTS} WHERE event_id % 5 <> 4""",
)
def _(spark, sf):
    out = ef.with_path_metadata(keys(spark, sf), "path")
    parts = [F.col(c) for c in ("year", "month", "day", "hour")]
    return out.select("event_id", "tenant_id", "dataset_id", F.concat(*parts).alias("hour_of"), "filename")


HINTS = "['ndjson','csv','apache','nginx','cef','influx','sflow','netflow','unknown','syslog']"


@query(
    "format_hint",
    f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN CASE WHEN {HINTS}[1 + user_id % 10] = 'unknown' THEN 'raw' ELSE {HINTS}[1 + user_id % 10] END
        WHEN 1 THEN 'raw' WHEN 2 THEN 'ndjson' ELSE 'raw' END AS format,
        CASE event_id % 4 WHEN 0 THEN 'gz' WHEN 1 THEN 'bz2' WHEN 2 THEN 'xz' ELSE '' END AS compression,
        event_id % 4 = 0 AND {HINTS}[1 + user_id % 10] IN ('sflow', 'netflow') AS "binary" FROM events""",
)
def _(spark, sf):
    hints = "element_at(array('ndjson','csv','apache','nginx','cef','influx','sflow','netflow','unknown','syslog'), cast(1 + user_id % 10 AS int))"
    name = f"""CASE event_id % 4 WHEN 0 THEN concat('a/b/', tenant_id, '--', dataset_id, '--', {hints}, '.txt.gz')
        WHEN 1 THEN concat(tenant_id, '--', dataset_id, '.csv.bz2') WHEN 2 THEN concat('x/', event_id, '.json.xz') ELSE 'data' END"""
    df = events(spark, sf).select("event_id", F.expr(name).alias("name"))
    return ef.with_format_hint(df, "name").drop("name")


@query(
    "parse_by_hint",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'apache' WHEN 1 THEN 'syslog' WHEN 2 THEN 'influx' ELSE 'iis' END AS format,
       CASE event_id % 4 WHEN 0 THEN 'h' || user_id END AS remote_addr, CASE event_id % 4 WHEN 1 THEN event_type END AS message,
       CASE event_id % 4 WHEN 2 THEN event_type END AS measurement, CASE event_id % 4 WHEN 3 THEN 'raw' || user_id END AS raw FROM events""",
)
def _(spark, sf):
    name = "concat('t--d--', element_at(array('apache', 'syslog', 'influx', 'iis'), cast(event_id % 4 + 1 AS int)), '.gz')"
    line = """CASE event_id % 4 WHEN 0 THEN concat('h', user_id, ' - - [t] "r" 200 1') WHEN 1 THEN concat('<1>Jan  1 00:00:00 h ', event_type)
        WHEN 2 THEN concat(event_type, ' v=1') ELSE concat('raw', user_id) END"""
    lines = table(spark, sf, "events").select("event_id", F.expr(name).alias("_file"), F.expr(line).alias("value"))
    out = ef.parse_by_hint(lines, formats=["apache", "syslog", "influx"])
    of = lambda form, name: F.when(F.col("format") == form, F.col(name)).alias(name)
    return out.select(
        "event_id", "format", "remote_addr", of("syslog", "message"), "measurement", of("iis", "raw")
    )


@query(
    "promote_variant",
    """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select(
        F.parse_json(F.expr("concat('{\"event_id\":', event_id, ',\"event_type\":\"', event_type, '\",', substr(props, 2))")).alias("record")
    )
    return ef.promote(df, "event_id bigint, event_type string, k bigint, absent string").drop("record")


@query(
    "select_source_files",
    f"""SELECT event_id, tenant_id FROM {EVENTS} WHERE event_id % 5 = 1
        AND (tenant_id = 't0' OR tenant_id = 't1' AND dataset_id IN ('click', 'view'))
        UNION ALL SELECT event_id, tenant_id FROM {EVENTS} WHERE event_id % 5 IN (2, 3)
        AND (tenant_id = 't0' OR tenant_id = 't1' AND dataset_id IN ('click', 'view'))""",
)
def _(spark, sf):
    # Tenant t0 takes every dataset, t1 two of them, t2 is not active.
    kinds = table(spark, sf, "events").select(F.col("event_type").alias("dataset_id")).distinct()
    tenants = kinds.select(
        F.explode(F.expr("array('t0', 't1', 't2')")).alias("tenant_id"), "dataset_id"
    ).where("tenant_id <> 't1' OR dataset_id IN ('click', 'view')")
    tenants = tenants.select(
        "tenant_id",
        (F.col("tenant_id") != "t2").alias("active"),
        F.when(F.col("tenant_id") != "t0", F.col("dataset_id")).alias("dataset_id"),
    )
    return ef.select_source_files(keys(spark, sf), tenants).select("event_id", "tenant_id")


@query(
    "read_write_undeclared_fields",
    """SELECT event_id, event_type, value, props, 'x' || user_id AS extra, CASE WHEN event_id % 2 = 0 THEN 'text' ELSE CAST(user_id AS VARCHAR) END AS user_id,
       't' || event_type AS tag FROM events""",
)
def _(spark, sf):
    source, target = ef.scratch_dir(spark, "lines"), ef.scratch_dir(spark, "back")
    typed = F.expr("CASE WHEN event_id % 2 = 0 THEN '\"text\"' ELSE cast(user_id AS string) END")
    line = F.concat(
        F.lit('{"user_id":'), typed, F.lit(","), F.substring(F.to_json(F.struct("event_id", "event_type", "value", "props", F.concat(F.lit("x"), "user_id").alias("extra"))), 2, 100000)
    )
    table(spark, sf, "events").select(line.alias("value")).write.text(source)
    # only two members are declared, one of them with a type that half of the lines do not have
    df = ef.read_events(spark, source, "event_id bigint, user_id bigint")
    df = ef.run_pipeline(df, [{"type": "add_field", "config": {"field": "tag", "value": "t"}}])
    df = df.withColumn("tag", F.concat("tag", F.try_element_at("_rest", F.lit("event_type")).cast("string")))
    ef.write_events(df, target, partition_by=())
    return spark.read.schema(
        "event_id bigint, event_type string, value double, props string, extra string, user_id string, tag string"
    ).json(target)


@query(
    "variant_chain",
    """SELECT event_id, value AS amount, 'click' AS event_type, 'eventflow' AS processed_by, 'v' AS mark FROM events WHERE event_type = 'click'""",
)
def _(spark, sf):
    source, target = ef.scratch_dir(spark, "lines"), ef.scratch_dir(spark, "back")
    table(spark, sf, "events").select(F.to_json(F.struct("event_id", "event_type", "value")).alias("value")).write.text(source)
    df = ef.read_events(spark, source)
    chain = [
        {"type": "include", "config": {"field": "event_type", "equals": "click"}},
        {"type": "rename_field", "config": {"from": "value", "to": "amount"}},
        {"type": "add_field", "config": {"field": "mark", "value": "v"}},
    ]
    df = ef.run_pipeline(ef.run_pipeline(df, chain), None)
    ef.write_events(df, target, partition_by=())
    names = "event_id bigint, amount double, event_type string, processed_by string, mark string"
    return spark.read.schema(names).json(target)


@query("read_events_roots", "SELECT event_id, 't' || (user_id % 2) AS tenant_id, event_type AS dataset_id FROM events")
def _(spark, sf):
    roots = [ef.scratch_dir(spark, "root") for _ in range(2)]
    df = table(spark, sf, "events").withColumns({"tenant": F.expr("concat('t', user_id % 2)"), "dataset": F.col("event_type")})
    lines = df.select("tenant", "dataset", F.to_json(F.struct("event_id")).alias("value"))
    for i, root in enumerate(roots):
        lines.where(F.col("tenant") == f"t{i}").write.partitionBy("tenant", "dataset").text(root)
    return ef.read_events(spark, roots, "event_id bigint", path_metadata=True).select("event_id", "tenant_id", "dataset_id")


HEADERS = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority, FALSE AS bad FROM orders"""


def _two_headers(spark, sf):
    path = ef.scratch_dir(spark, "headers")
    orders = table(spark, sf, "orders")
    orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.csv(path, header=True)
    orders.where("o_orderkey % 2 <> 0").select("o_orderstatus", "o_orderkey").write.mode("append").csv(path, header=True)
    return path


@query("read_csv_headers", HEADERS)
def _(spark, sf):
    out = ef.read_delimited(spark, _two_headers(spark, sf))
    return out.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.col("_error").isNotNull().alias("bad"))


@query("read_csv_one_scan", HEADERS)
def _(spark, sf):
    out = ef.read_delimited_records(spark, _two_headers(spark, sf), columns=["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return out.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.col("_error").isNotNull().alias("bad"))


def _delimited(spark, sf, delimiter):
    path = ef.scratch_dir(spark, "delimited")
    df = table(spark, sf, "orders").select("o_orderkey", F.expr("concat(o_orderpriority, ', \"', o_orderstatus, '\"')").alias("note"))
    df.write.csv(path, header=True, sep=delimiter, escape='"')
    return ef.read_delimited(spark, path, delimiter).select("o_orderkey", "note", F.col("_error").isNotNull().alias("bad"))


DELIMITED = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority || ', "' || o_orderstatus || '"' AS note,
    FALSE AS bad FROM orders"""


@query("read_csv", DELIMITED)
def _(spark, sf):
    return _delimited(spark, sf, ",")


@query("read_tsv", DELIMITED)
def _(spark, sf):
    return _delimited(spark, sf, "\t")


@query("write_events", f"SELECT event_id, value, tenant_id, dataset_id, props FROM {EVENTS}")
def _(spark, sf):
    path = ef.scratch_dir(spark, "written")
    ef.write_events(events(spark, sf), path, rebalance=True)
    back = spark.read.schema("event_id bigint, value double, props string, tenant_id string, dataset_id string").json(path)
    return back.select("event_id", "value", "tenant_id", "dataset_id", "props")


@query(
    "route_errors",
    f"""SELECT 'good' AS side, event_type AS kind, count(*) AS n FROM events GROUP BY ALL
        UNION ALL SELECT 'dead', 'line is not a JSON object', count(*) FROM events WHERE event_id % 100 = 7 HAVING count(*) > 0""",
)
def _(spark, sf):
    df = ef.read_events(spark, written(spark, sf), SCHEMA)
    good, dead = ef.scratch_dir(spark, "good"), ef.scratch_dir(spark, "dead")
    ef.route_errors(df, good, dead, partition_by=())
    kept = ef.read_events(spark, good, SCHEMA).select(F.lit("good").alias("side"), F.col("event_type").alias("kind"))
    lost = spark.read.parquet(dead).select(F.lit("dead").alias("side"), F.col("_error").alias("kind"))
    return kept.unionByName(lost).groupBy("side", "kind").agg(F.count("*").alias("n"))


@query(
    "write_manifest",
    f"""SELECT 't' || (user_id % 3) AS tenant_id, event_type AS dataset_id, 'ndjson' AS format,
        count(*) + count(*) FILTER (event_id % 100 = 7) AS input_records,
        count(*) FILTER (value >= 10) + count(*) FILTER (event_id % 100 = 7) AS output_records,
        'chain-1' AS pipeline_id, TRUE AS stamped FROM events GROUP BY 1, 2""",
)
def _(spark, sf):
    source = written(spark, sf)
    lines = ef.read_lines(spark, source).select("value", F.col("_metadata.file_path").alias("_file"))
    df = decode_lines(lines, SCHEMA)
    part = lambda name: F.regexp_extract("_file", name + "=([^/]+)", 1)
    df = df.withColumns({"tenant_id": part("tenant_id"), "dataset_id": part("dataset_id")})
    audited = ef.run_pipeline_audited(
        df, [{"type": "conditional", "config": {"field": "value", "operator": "gte", "value": 10}}]
    )
    path = ef.scratch_dir(spark, "manifest")
    ef.write_manifest(audited, path, "chain-1")
    rows = spark.read.parquet(path)
    return rows.groupBy("tenant_id", "dataset_id", "format", "pipeline_id").agg(
        F.sum("input_records").alias("input_records"),
        F.sum("output_records").alias("output_records"),
        F.bool_and(F.col("processed_at").isNotNull()).alias("stamped"),
    )
