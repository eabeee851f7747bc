"""Chains merged over one input give the rows of the branches."""

import json

from pyspark.sql import functions as F

import eventflow as ef


def step(kind, condition=None, **config):
    return {"type": kind, "config": config, **({"condition": condition} if condition else {})}


LINE = step("grok", source_field="line", pattern="%{WORD:verb} %{NUMBER:size}")
CHAINS = {
    ("t0", "d0"): [LINE, step("conditional", field="id", operator="gte", value=20)],
    ("t0", "d1"): [LINE, step("remove_field", field="line"), step("add_field", field="mark", value="m")],
    ("t0", "d2"): [step("split", field="tags", terminator=",")],
    ("t1", "d0"): [step("rename_field", **{"from": "tags", "to": "label"}), step("uppercase_keys", source_field="m")],
    ("t1", "d1"): [step("drop", if_field="line", contains="7"), step("add_field", condition="id % 2 = 0", field="mark", value="even")],
    ("t1", "d2"): [step("enricher", enricher_id="l", source_field="tags", target_field="found", index_column="k")],
    ("t2", "d0"): [step("geoip", source_field="ip", fields=["city"]), step("mutate", uppercase=["line"])],
    ("t2", "d1"): [LINE, step("kv", source_field="pairs", target_field="kv"), step("plus_one")],
    ("t2", "d2"): [],
}


def rows(df, names):
    # columns and maps as JSON with sorted names
    shown = [F.to_json(F.struct(*[F.col(f"`{n}`") for n in sorted(names) if n in df.columns])).alias("j")]
    return sorted(json.dumps(json.loads(r.j), sort_keys=True) for r in df.select(shown).collect())


def table(spark, path):
    df = spark.range(600).selectExpr(
        "id", "concat('t', id % 4) AS tenant_id", "IF(id % 37 = 0, NULL, concat('d', id div 4 % 3)) AS dataset_id",
        "concat('get ', id * 7) AS line", "concat('a', id % 3, ',b') AS tags", "map('k', id) AS m", "concat('10.0.0.', id % 256) AS ip",
        "concat('x=', id, ' y=', id % 5) AS pairs", "IF(id % 11 = 0, 'bad line', NULL) AS _error",
    )
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_merged_chains_equal_branches(spark, tmp_path):
    ef.register_filter("plus_one", lambda df, config: df.withColumn("id", F.col("id") + 1))
    df = table(spark, str(tmp_path / "in"))
    tables = {
        "l": spark.createDataFrame([("a1,b", "one")], "k string, v string"),
        "geoip": spark.createDataFrame([("10.0.0.0", "10.0.0.99", "low")], "start_ip string, end_ip string, city_name string"),
    }
    once, each = ef.route_once(df, CHAINS, tables), ef.route(df, CHAINS, tables)
    assert {c.lower() for c in once.columns} == {c.lower() for c in each.columns}
    types = {f.name.lower(): f.dataType.simpleString() for f in each.schema.fields}
    assert {f.name.lower(): f.dataType.simpleString() for f in once.schema.fields} == types
    assert rows(once, each.columns) == rows(each, each.columns) and once.count() > 500


def test_many_chains_read_once(spark, tmp_path):
    df = table(spark, str(tmp_path / "in"))
    specs = {(f"t{i % 4}", f"d{i // 4}"): [LINE, step("add_field", field=f"f{i % 9}", value=f"v{i}")] for i in range(50)}
    out = ef.route_once(df, specs)
    # the shared step is there once, for all chains
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = out.collect()
    assert len(got) == df.count()
    for r in got:
        i = 4 * int(r.dataset_id[1:]) + int(r.tenant_id[1:]) if r.dataset_id else None
        clean = r._error is None
        assert (r.verb == "get") == (clean and r.dataset_id is not None)
        assert {k: v for k, v in r.asDict().items() if k[0] == "f" and v} == ({f"f{i % 9}": f"v{i}"} if clean and i is not None else {})


def test_clashing_types_become_variants(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", "a", "5"), (2, "t", "b", "6"), (3, "t", "c", "7")], "id int, tenant_id string, dataset_id string, v string")
    specs = {("t", "a"): [step("mutate", convert={"v": "integer"})], ("t", "b"): [step("mutate", split={"field": "v", "separator": ","})]}
    out = ef.route_once(df, specs, fallback={"filters": []})
    got = {r.id: r.j for r in out.select("id", F.to_json("v").alias("j")).collect()}
    assert out.schema["v"].dataType.simpleString() == "variant" and got == {1: "5", 2: '["6"]', 3: '"7"'}


def test_open_records_and_nothing(spark):
    lines = [json.dumps({"tenant_id": f"t{i % 2}", "dataset_id": "d", "id": i, "host": f"h{i}", "deep": {"x": i}}) for i in range(20)]
    df = ef.read_events
    from eventflow.sources.events import decode_lines

    df = decode_lines(spark.createDataFrame([(x,) for x in [*lines, "broken"]], "value string"), "tenant_id string, dataset_id string, id bigint")
    specs = {("t0", "d"): [step("rename_field", **{"from": "host", "to": "machine"}), step("include", field="machine", matches="[24]")]}
    both = [rows(f(df, specs), ["id", "machine", "processed_by", "_error", "_raw"]) for f in (ef.route, ef.route_once)]
    assert both[0] == both[1] and len(both[0]) > 10
    lines = [sorted(json.dumps(json.loads(r.j), sort_keys=True) for r in f(df, specs).where("_error IS NULL").select(F.to_json("_rest").alias("j")).collect()) for f in (ef.route, ef.route_once)]
    assert lines[0] == lines[1]
    assert ef.route_once(df.limit(0), specs).collect() == []
