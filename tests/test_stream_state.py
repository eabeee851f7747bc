"""Streams that are killed and started again: dead letters, versions of look-ups, running metrics."""

import json

import pytest
from pyspark.sql import functions as F

import eventflow as ef
from eventflow.streaming import committed, letters, publish, route_errors_stream, versioned_stream, versions
from eventflow.streaming.files import names, write_once
from eventflow.streaming.runner import latest_metrics, metrics_stream

SCHEMA = "id bigint, k string"


def lines(spark, path, low, high):
    rows = [(json.dumps({"id": i, "k": f"k{i % 3}"}) if i % 5 else f"broken {i}",) for i in range(low, high)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(path)


def run(query):
    try:
        query.awaitTermination()
    except Exception as error:  # noqa: BLE001  (the kill of a test)
        return str(error)


@pytest.mark.parametrize("moment", ["before", "between", "after"])
def test_dead_letters_survive_a_kill(spark, tmp_path, monkeypatch, moment):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    go = lambda: run(route_errors_stream(ef.read_events_stream(spark, source, SCHEMA), out, checkpoint, partition_by=()))
    lines(spark, source, 0, 20)
    assert go() is None
    lines(spark, source, 20, 50)
    with monkeypatch.context() as patch:
        if moment == "after":  # both sides are written, the marker is not
            patch.setattr(letters, "write_once", lambda *a: 1 / 0)
        else:
            def killed(df, good, dead, partition_by, mode):
                if moment == "between":
                    df.where("_error IS NULL").select(F.to_json(F.struct("id", "k"))).write.mode(mode).text(good)
                raise RuntimeError("killed")

            patch.setattr(letters, "route_errors", killed)
        assert go() is not None
    good, dead = committed(spark, out)
    assert len(good) == len(dead) == 1
    assert go() is None
    good, dead = committed(spark, out)
    assert len(good) == 2
    ids = [r.id for folder in good for r in ef.read_events(spark, folder, SCHEMA).collect()]
    lost = [r._raw for folder in dead for r in spark.read.parquet(folder).collect()]
    assert sorted(ids) == [i for i in range(50) if i % 5]
    assert sorted(lost) == sorted(f"broken {i}" for i in range(0, 50, 5))


def chain(mark):
    return [
        {"type": "add_field", "config": {"field": "mark", "value": mark}},
        {"type": "enricher", "config": {"enricher_id": "l", "source_field": "k", "target_field": "e", "index_column": "k"}},
    ]


def test_a_repeated_batch_keeps_its_version(spark, tmp_path, monkeypatch):
    store, source, out, checkpoint = (str(tmp_path / n) for n in ("store", "in", "out", "cp"))
    look_up = lambda v: spark.createDataFrame([("k0", v), ("k1", v)], "k string, v string")
    go = lambda: run(versioned_stream(ef.read_events_stream(spark, source, SCHEMA), store, out, checkpoint, partition_by=()))
    assert publish(spark, store, chain("one"), {"l": look_up("a"), "same": look_up("s")}) == 1
    lines(spark, source, 0, 10)
    assert go() is None
    lines(spark, source, 10, 20)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "event_lines", lambda *a: 1 / 0)
        assert go() is not None  # the batch has failed after its version was chosen
    assert publish(spark, store, chain("two"), {"l": look_up("b"), "same": look_up("s")}) == 2
    assert publish(spark, store, chain("two"), {"l": look_up("b"), "same": look_up("s").repartition(3)}) == 2
    assert go() is None
    lines(spark, source, 20, 30)
    assert go() is None
    rows = ef.read_events(spark, out, "id bigint, mark string, e struct<v:string>").where("id IS NOT NULL").collect()
    assert {(r.id // 10, r.mark) for r in rows} == {(0, "one"), (1, "one"), (2, "two")}
    assert {(r.mark, r.e.v) for r in rows if r.e} == {("one", "a"), ("two", "b")} and len(rows) == 24


def test_unchanged_tables_are_not_read_again(spark, tmp_path):
    store = str(tmp_path)
    a, b = (spark.range(n).selectExpr("CAST(id AS STRING) AS k", "id AS v") for n in (3, 4))
    used = versions.Versions(store)
    publish(spark, store, chain("one"), {"l": a, "m": a})
    used.use(spark, 1)
    held = dict(used.tables)
    publish(spark, store, chain("two"), {"l": a, "m": b})
    used.use(spark, 2)
    assert used.tables["l"] is held["l"] and used.tables["m"] is not held["m"] and used.tables["m"].count() == 4
    assert used.spec == chain("two") and len(names(spark, f"{store}/tables/l")) == 1
    publish(spark, store, chain("two"), {"m": b})
    used.use(spark, 3)
    assert set(used.tables) == {"m"}
    with pytest.raises(ValueError, match="no version 9"):
        used.use(spark, 9)
    assert write_once(spark, f"{store}/x", "first") == write_once(spark, f"{store}/x", "second") == "first"


def test_running_metrics_have_the_last_error(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    df = spark.range(90).selectExpr(
        "concat('t', id % 2) AS tenant_id", "'d' AS dataset_id", "timestamp_seconds(1700000000 + id * 7919 % 90 * 10) AS at",
        "IF(id % 4 = 0, concat('error ', id), NULL) AS _error", "id % 9 = 1 AS _skipped", "id",
    )
    # the batches come out of order, with a restart between each
    for low in (60, 0, 30):
        df.where((F.col("id") >= low) & (F.col("id") < low + 30)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        metrics_stream(stream, out, checkpoint, "at").awaitTermination()
    want = ef.dataset_metrics(df, "at")
    got = latest_metrics(spark.read.parquet(out)).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
