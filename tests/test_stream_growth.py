"""What of a stream grows with its input: the number of files and of tasks, not the rows of one task or of a dataset's state."""

import json

import pandas as pd
from eventflow_catalog import streams

import eventflow as ef
from eventflow.streaming import runner
from eventflow.streaming.keyed_alerts import _Slices


class _State:
    """List state and timers in memory."""

    def __init__(self):
        self.rows, self.timers, self.mark = [], [], 0

    def getListState(self, name, schema):
        return self

    def appendList(self, rows):
        self.rows += rows

    def put(self, rows):
        self.rows = list(rows)

    def get(self):
        return iter(self.rows)

    def exists(self):
        return bool(self.rows)

    def clear(self):
        self.rows = []

    def registerTimer(self, at):
        self.timers.append(at)

    def listTimers(self):
        return iter(self.timers)

    def getCurrentWatermarkInMs(self):
        return self.mark


def test_files_grow_in_number(spark, sf, monkeypatch):
    made = []
    monkeypatch.setattr(ef, "read_events_stream", lambda spark, path, schema, max_files: made.append((path, max_files)) or spark.range(1).selectExpr("id AS user_id", "'a' AS event_type", "'' AS at"))
    monkeypatch.setattr(streams, "FILE_EVENTS", 40)
    streams._stream(spark, sf)
    events = spark.read.parquet(f"{sf}/events.parquet").count()
    path, batch = made[-1]
    sizes = [r["count"] for r in spark.read.text(path).selectExpr("_metadata.file_path AS f").groupBy("f").count().collect()]
    # two batches, of as many files as the rows ask for
    assert sum(sizes) == events and len(sizes) >= 0.8 * events / 40 and max(sizes) <= 80 and batch == -(--(-events // 40) // 2)
    arriving = streams._Arriving(spark, sf)
    arriving.write(0, 1)
    arriving.stream()
    path, batch = made[-1]
    one = spark.read.text(path).selectExpr("_metadata.file_path AS f").distinct().count()
    # a batch is a slice
    assert one == batch == -(-(events // arriving.slices) // 40)


def test_a_slice_holds_the_newest_results_only():
    state, slices = _State(), _Slices("", 2, window_size=10, check_seconds=300)
    slices.init(state)
    minute = 60_000_000
    frames = [pd.DataFrame({"k": ["t"] * 500, "s": [0] * 500, "at": [(i % 12) * minute + i for i in range(n, n + 500)], "id": range(n, n + 500), "failed": [1] * 500}) for n in (0, 500)]
    list(slices.handleInputRows(("t", 0), iter(frames), None))
    # the first row is at second 0, the others belong to the checks at 300, 600 and 900 seconds
    assert [len(json.loads(found)) for _, found in state.rows] == [1, 10, 10, 10]
    state.mark = 601_000
    [out] = list(slices.handleExpiredTimer(("t", 0), state, None))
    every = pd.concat(frames)
    for second in (300, 600):
        due = every[(every["at"] > (second - 300) * 1_000_000) & (every["at"] <= second * 1_000_000)]
        assert sorted(out[out[3] == second][4]) == sorted(due["at"])[-10:]
    assert all(second > 600_000_000 for second, _ in state.rows) and state.rows


def test_a_batch_joined_back_is_decoded_once(spark, monkeypatch, tmp_path):
    kept = []
    monkeypatch.setattr(runner, "start", lambda stream, write, checkpoint, trigger: write(stream, 0))
    monkeypatch.setattr(runner, "run_pipeline", lambda batch, *a, **k: kept.append(batch.is_cached) or batch)
    rows = spark.createDataFrame([("curl/8.0",)], "user_agent string")
    for spec in ([{"type": "useragent", "config": {"distinct": True}}], [{"type": "useragent", "config": {}}]):
        runner.run_stream(rows, spec, str(tmp_path / str(len(kept))), "", partition_by=(), batches=True)
    assert kept == [True, False] and not rows.is_cached
