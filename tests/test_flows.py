"""Windows, alerts, files and streams against brute force."""

import gzip
import glob
from collections import defaultdict

from pyspark.sql import functions as F

import eventflow as ef
from eventflow.operators import enrich
from eventflow.streaming import alert_stream, finish_alerts, run_stream
from eventflow.streaming.runner import AVAILABLE_NOW


def results(spark, n=3000):
    """One dataset holds most of the rows; the failure share drifts."""
    return spark.range(n).selectExpr(
        "id",
        "timestamp_seconds(1700000000 + id * 20 + (id * 7919) % 13) AS at",
        "'t' AS tenant_id",
        "CASE WHEN id % 10 < 8 THEN 'big' ELSE concat('d', id % 7) END AS dataset_id",
        "pmod(hash(id), 100) < 10 + 30 * (id div 500 % 2) AS failed",
    )


def brute_rates(rows, window):
    recent, out = defaultdict(list), {}
    for r in sorted(rows, key=lambda r: (r.at, r.id)):
        kept = recent[r.dataset_id]
        kept.append(r.failed)
        del kept[:-window]
        out[r.id] = (len(kept), sum(kept))
    return out


def brute_alerts(rows, rates, threshold, minimum, cooldown, check):
    last = {}
    for r in sorted(rows, key=lambda r: (r.at, r.id)):
        tick = -(-int(r.at.timestamp() * 1000000) // (check * 1000000)) * check
        last[r.dataset_id, tick] = rates[r.id]
    silent, fired = {}, []
    for (dataset, tick), (n, f) in sorted(last.items(), key=lambda x: x[0][1]):
        if n >= minimum and f * 100 / n >= threshold and tick - silent.get(dataset, -(10**12)) >= cooldown:
            silent[dataset] = tick
            fired.append((dataset, tick, n, f))
    return sorted(fired)


def test_failure_rate_equals_brute_force(spark):
    df = results(spark)
    expected = brute_rates(df.collect(), 100)
    for parts in ("1", "3", "37"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out = ef.failure_rate(df, "failed", ("at", "id"))
        assert {r.id: (r.recent_samples, r.recent_failures) for r in out.collect()} == expected
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_alerts_equal_brute_force(spark):
    df = results(spark)
    rows = df.collect()
    rates = brute_rates(rows, 100)
    out = ef.failure_alerts(ef.failure_rate(df, "failed", ("at", "id")), "at", ("at", "id"))
    got = sorted((r.dataset_id, int(r.alert_time.timestamp()), r.recent_samples, r.recent_failures) for r in out.collect())
    assert got == brute_alerts(rows, rates, 20, 10, 1800, 300) and len(got) > 5


def test_alert_stream_equals_batch(spark, tmp_path):
    df = results(spark, 1500)
    source = str(tmp_path / "in")
    # Batches end inside checks, and rows of a batch may belong up to 20 minutes before its start.
    cuts = [1700000000, 1700006333, 1700019777, 1700040000]
    part_of = F.unix_seconds("at") + (F.col("id") % 7) * 170
    runs = []
    for i, (low, high) in enumerate(zip(cuts, [*cuts[1:], 1 << 40])):
        part = df.where((part_of > low) & (part_of <= high) | (F.lit(i == 0) & (part_of <= low)))
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        run = alert_stream(
            stream, "failed", "at", ("at", "id"), str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"),
            delay_seconds=1200, trigger=AVAILABLE_NOW,
        )
        run.awaitTermination()
        runs.append(run.lastProgress["batchId"])
    finish_alerts(spark, max(runs), str(tmp_path / "out"), str(tmp_path / "state"), ("at", "id"))
    columns = ["dataset_id", "alert_time", "recent_samples", "recent_failures", "severity"]
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(columns).collect()))
    batch = ef.failure_alerts(ef.failure_rate(df, "failed", ("at", "id")), "at", ("at", "id"))
    assert got == sorted(map(tuple, batch.select(columns).collect())) and got


def test_read_write_round_trip(spark, tmp_path):
    source = tmp_path / "tenant=a" / "dataset=b"
    source.mkdir(parents=True)
    with gzip.open(source / "f.gz", "wt") as f:
        f.write('{"x":1,"y":"s"}\n\n  \nbroken\n{"x":"text","y":null}\n[1]\n')
    df = ef.read_events(spark, str(tmp_path / "tenant=a"), "x bigint, y string")
    rows = sorted((r.x or 0, r.y or "", r._raw or "", bool(r._error)) for r in df.collect())
    assert rows == [(0, "", "", False), (0, "", "[1]", True), (0, "", "broken", True), (1, "s", "", False)]
    chained = ef.run_pipeline(df, [{"type": "add_field", "config": {"field": "z", "value": "1"}}])
    ef.write_events(chained, str(tmp_path / "out"), partition_by=())
    lines = [line for f in glob.glob(str(tmp_path / "out" / "*.gz")) for line in gzip.open(f, "rt").read().splitlines()]
    assert sorted(lines) == sorted(['{"x":1,"y":"s","z":"1"}', "broken", '{"z":"1","x":"text"}', "[1]"])


def test_path_metadata_of_files(spark, tmp_path):
    source = tmp_path / "t1" / "logs"
    source.mkdir(parents=True)
    (source / "f.json").write_text('{"a":1}\n')
    for path in (str(tmp_path), "file://" + str(tmp_path) + "/"):
        row = ef.read_events(spark, path, "a int", path_metadata=True).first()
        assert (row.tenant_id, row.dataset_id, row.a) == ("t1", "logs", 1)


def test_delimited_errors(spark, tmp_path):
    (tmp_path / "f.tsv").write_text("a\tb\n1\t2\n3\n4\t5\t6\n")
    rows = ef.read_delimited(spark, str(tmp_path / "f.tsv"), "\t").collect()
    assert [(r.a, bool(r._error)) for r in rows] == [("1", False), ("3", True), ("4", True)]


def test_dead_letters(spark, tmp_path):
    df = spark.createDataFrame([("<1>Oct 11 22:14:15 h m",), ("bad",)], "message string")
    parsed = ef.parse(df, parser_name="syslog-rfc3164")
    ef.route_errors(parsed, str(tmp_path / "good"), str(tmp_path / "dead"), partition_by=())
    assert spark.read.json(str(tmp_path / "good")).first().hostname == "h"
    assert spark.read.parquet(str(tmp_path / "dead")).first()._parse_failure.startswith("line does not match")


def test_conditions_guard_every_kind_of_step(spark):
    df = spark.createDataFrame([(1, "a,b", "x"), (2, "c,d", "y")], "id int, tags string, k string")
    spec = [
        {"type": "split", "condition": "id = 1", "config": {"field": "tags", "terminator": ","}},
        {"type": "uppercase_keys", "condition": "id = 1", "config": {"source_field": "none"}},
        {"type": "remove_field", "condition": "id = 2", "config": {"field": "k"}},
    ]
    rows = sorted((r.id, r.tags, r.k) for r in ef.run_pipeline(df, spec).fillna("-").collect())
    assert rows == [(1, "a", "x"), (1, "b", "x"), (2, "c,d", "-")]


def test_route_reads_only_its_partitions(spark, tmp_path):
    df = spark.range(30).selectExpr("id", "concat('t', id % 3) AS tenant_id", "concat('d', id % 2) AS dataset_id")
    df.write.partitionBy("tenant_id", "dataset_id").parquet(str(tmp_path / "in"))
    mark = [{"type": "add_field", "config": {"field": "m", "value": "x"}}]
    out = ef.route(spark.read.parquet(str(tmp_path / "in")), {("t0", "d0"): mark, ("t1", "d1"): mark}, fallback={"filters": []})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [((") == 2
    assert {(r.id % 3, r.id % 2) for r in out.collect() if r.m} == {(0, 0), (1, 1)} and out.count() == 30


def test_big_lookup_on_stream(spark, tmp_path):
    spark.range(20).selectExpr("concat('k', id % 4) AS k", "id").write.parquet(str(tmp_path / "in"))
    lookup = spark.createDataFrame([("k1", "one")], "k string, v string")
    stream = spark.readStream.schema("k string, id bigint").parquet(str(tmp_path / "in"))
    out = ef.enricher(stream, enricher_id="l", source_field="k", target_field="e", tables={"l": lookup}, broadcast=False)
    run = out.select("id", "e.v").writeStream.format("memory").queryName("big_lookup").trigger(availableNow=True).start()
    run.awaitTermination()
    rows = spark.table("big_lookup").collect()
    assert len(rows) == 20 and {r.id for r in rows if r.v == "one"} == {1, 5, 9, 13, 17}


def test_catalogue_small(spark, sf):
    """Every catalogued query agrees with its DuckDB equivalent on the smallest tables."""
    import sys, os

    sys.path.insert(0, os.path.dirname(__file__))
    from oracle_check import compare, connect

    from eventflow_catalog import ORACLES, QUERIES

    con = connect(sf)
    problems = {n: p for n in ORACLES if (p := compare(spark, con, n, QUERIES[n], ORACLES[n], sf))}
    assert problems == {}


def test_stream_output_survives_a_grown_lookup(spark, tmp_path):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    chain = [{"type": "enricher", "config": {"enricher_id": "l", "source_field": "k", "target_field": "e"}}]
    for i, rows in enumerate((10, 100)):
        spark.createDataFrame([(f"k{i}", i)], "k string, id bigint").write.mode("append").parquet(source)
        lookup = spark.range(rows).selectExpr("concat('k', id) AS k", "id AS v")
        stream = spark.readStream.schema("k string, id bigint").parquet(source)
        before, enrich.BROADCAST_ROWS = enrich.BROADCAST_ROWS, 50
        try:
            run_stream(stream, chain, out, checkpoint, {"l": lookup}, partition_by=()).awaitTermination()
        finally:
            enrich.BROADCAST_ROWS = before
    rows = ef.read_events(spark, out, "id bigint, e struct<v:bigint>").select("id", "e.v").collect()
    assert sorted(map(tuple, rows)) == [(0, 0), (1, 1)]


def test_conditional_custom_steps_read_once(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    ef.register_filter("plus_one", lambda df, config: df.withColumn("n", F.col("n") + 1))
    df = spark.read.parquet(str(tmp_path / "in")).withColumn("n", F.lit(0))
    out = ef.run_pipeline(df, [{"type": "plus_one", "config": {}, "condition": "id % 2 = 0"}] * 6)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {(r.id % 2, r.n) for r in out.collect()} == {(0, 6), (1, 0)}


def test_files_are_scanned_as_often_as_needed(spark, tmp_path):
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    spark.range(9).selectExpr("concat('t--d--', if(id % 2 = 0, 'cef', 'influx'), '.gz') AS _file", "'x v=1' AS value").write.parquet(str(tmp_path / "l"))
    assert scans(ef.parse_by_hint(spark.read.parquet(str(tmp_path / "l")), formats=["cef", "influx", "syslog"])) == 1
    spark.range(9).selectExpr("concat('k', id) AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    joined = ef.enricher(table, enricher_id="t", source_field="k", target_field="e", tables={"t": table}, broadcast=False)
    assert scans(joined) == 2 and joined.count() == 9


def test_names_of_several_fields_take_one_join(spark):
    names = spark.createDataFrame([(f"h{i}", f"10.0.0.{i}") for i in range(9)], "name string, resolved string")
    df = spark.range(40).selectExpr("id", "concat('h', id % 12) AS a", "IF(id % 5 = 0, NULL, concat('h', id % 7)) AS b", "concat('h', id % 3) AS c")
    want = {i: (f"10.0.0.{i % 12}" if i % 12 < 9 else f"h{i % 12}", None if i % 5 == 0 else f"10.0.0.{i % 7}", f"10.0.0.{i % 3}") for i in range(40)}
    for broadcast in (True, False):
        out = ef.dns(df, resolve=["a", "b", "c", "none"], tables={"dns": names}, broadcast=broadcast)
        assert {r.id: (r.a, r.b, r.c) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # one join of the names with the distinct tuples, one of the rows
    assert plan.count("SortMergeJoin") == 2


def test_schemas_read_their_input_once(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(50).selectExpr("id", "IF(id % 3 = 0, NULL, 'x') AS x", "to_json(named_struct('id', id, 'k', IF(id % 2 = 0, 'v', NULL))) AS j").write.parquet(path)
    df = spark.read.parquet(path)
    whole = {r.field: (r.types, r.sample_count) for r in ef.schema_union(df).collect()}
    assert whole == {"id": (["number"], 50), "x": (["string"], 50), "j": (["string"], 50)}
    inside = {r.field: (r.type, r["count"], r.nullable) for r in ef.schema_profile(df, "id", "j").collect()}
    assert inside == {"id": ("number", 50, False), "k": ("string", 25, True)}
    assert path not in ef.schema_union(df)._jdf.queryExecution().executedPlan().toString()
    assert ef.schema_union(df.limit(0)).collect() == [] and ef.schema_profile(df.where("id < 0"), "id", "j").collect() == []
    metrics = ef.dataset_metrics(df.selectExpr("id", "'t' AS tenant_id", "'d' AS dataset_id", "timestamp_seconds(id) AS at", "x AS _error"), "at")
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    # the rows are aggregated by hash; only what is left of them is sorted
    assert plan.count("FileScan") == 1 and plan.index("HashAggregate") > plan.index("SortAggregate")
    assert metrics.first().last_error == "x"
