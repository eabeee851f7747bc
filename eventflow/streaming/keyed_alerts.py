"""Failure alerts over a stream with keyed state.

Two stateful steps.  A dataset's results are held in slices, so that no task has a whole dataset; of each batch a slice holds the newest
results of an open check, ``window_size`` at most, as no older one can count.  When the watermark passes a check, an event-time timer
closes it and each slice hands on its newest results of that check, ``window_size`` at most.  The
second step has one key for each dataset and keeps its newest ``window_size`` results and its last alert; it sees
``slices * window_size`` rows of a check at most, however many there were.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import text as tx
from ..operators.alerts import KEY, severity
from .runner import AVAILABLE_NOW

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MILLION = 1_000_000


class _Slices(StatefulProcessor):
    """Per dataset and slice: the newest results of open checks, ``window_size`` at most of a check and batch, as one text each."""

    def __init__(self, results: str, keys: int, window_size: int, check_seconds: int):
        self.results, self.keys, self.window, self.check = results, keys, window_size, check_seconds * MILLION

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "second bigint, results string")

    def _newest(self, frame: pd.DataFrame) -> pd.DataFrame:
        """The newest results of each check; the first column is the event time."""
        frame = frame.sort_values(list(frame.columns), ignore_index=True)
        check = -(-frame[frame.columns[0]] // self.check) * self.check
        return frame.groupby(check, sort=False).tail(self.window)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        kept, fresh, waiting = None, [], 0
        for frame in rows:
            frame = frame[frame.columns[self.keys :]]
            fresh.append(frame)
            waiting += len(frame)
            # cut down only when as many have come as are held, so that a row is sorted a few times at most
            if waiting >= max(100_000, 0 if kept is None else len(kept)):
                kept, fresh, waiting = self._newest(pd.concat([kept, *fresh] if kept is not None else fresh)), [], 0
        if fresh:
            kept = self._newest(pd.concat([kept, *fresh] if kept is not None else fresh))
        if kept is None or kept.empty:
            return iter([])
        columns = [kept[c].tolist() for c in kept.columns]
        checks: dict[int, list[tuple]] = {}
        for result in zip(*columns, strict=True):
            checks.setdefault(-(-result[0] // self.check) * self.check, []).append(result)
        self.open.appendList([(second, json.dumps(found)) for second, found in checks.items()])
        self._wake(min(checks), list(self.handle.listTimers()))
        return iter([])

    def _wake(self, second: int, known: list[int]) -> None:
        """A timer for the first open check, which is closed once the watermark is beyond it."""
        due = second // 1000 + 1
        if not known or due < min(known):
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        last = (mark - 1) * 1000 // self.check * self.check
        checks: dict[int, list[tuple]] = {}
        if self.open.exists():
            for second, found in self.open.get():
                checks.setdefault(second, []).extend(tuple(r) for r in json.loads(found))
        newest = {second: sorted(found)[-self.window :] for second, found in checks.items()}
        left = [(second, json.dumps(found)) for second, found in sorted(newest.items()) if second > last]
        if left:
            self.open.put(left)
            self._wake(left[0][0], [t for t in self.handle.listTimers() if t > mark])
        else:
            self.open.clear()
        out = [(*key, pd.Timestamp(mark, unit="ms"), second // MILLION, *r) for second in sorted(newest) if second <= last for r in newest[second]]
        if out:
            yield pd.DataFrame(dict(enumerate(zip(*out, strict=True))))

    def close(self) -> None:
        pass


class _Datasets(StatefulProcessor):
    """Per dataset: its newest results and its last alert; judges the checks that were closed."""

    def __init__(self, results: str, before: int, window_size: int, threshold: float, minimum_samples: int, cooldown_seconds: int):
        self.results, self.before, self.window = results, before, window_size
        self.threshold, self.minimum, self.cooldown = threshold, minimum_samples, cooldown_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", self.results)
        self.silence = handle.getValueState("silence", "second bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        checks: dict[int, list[tuple]] = {}
        for frame in rows:
            columns = frame.columns[self.before :]
            for check, *result in zip(*[frame[c].tolist() for c in columns], strict=True):
                checks.setdefault(check, []).append(tuple(result))
        ring = [tuple(r) for r in self.ring.get()] if self.ring.exists() else []
        last = self.silence.get()[0] if self.silence.exists() else None
        fired = []
        for check in sorted(checks):
            ring = sorted(ring + checks[check])[-self.window :]
            failures = sum(r[-1] for r in ring)
            rate = failures * 100.0 / len(ring)
            if rate >= self.threshold and len(ring) >= self.minimum and (last is None or check - last >= self.cooldown):
                last = check
                fired.append((*key, check, len(ring), failures, rate))
        self.ring.put(ring)
        if fired:
            self.silence.update((last,))
            yield pd.DataFrame(dict(enumerate(zip(*fired, strict=True))))

    def close(self) -> None:
        pass


def keyed_alerts(
    stream: DataFrame,
    failed: str,
    time_column: str,
    order_by: tuple[str, ...],
    window_size: int = 100,
    threshold: float = 20.0,
    minimum_samples: int = 10,
    cooldown_seconds: int = 1800,
    check_seconds: int = 300,
    by: tuple[str, ...] = KEY,
    delay_seconds: int = 0,
    slices: int = 16,
    heartbeat: Column | None = None,
) -> DataFrame:
    """Alerts of a stream as :func:`eventflow.failure_alerts` finds them over all rows, each as its check closes.

    A check closes when a result more than ``delay_seconds`` after it has come.  Later results are late for the watermark and are
    left out, which the query's progress counts.  ``order_by`` starts with the event time; its other columns are compared as integers or
    as text.  Rows for which ``heartbeat`` is true move the time and count for nothing.  Rows without an event time are left out.

    State grows with the open checks (``window_size`` results at most a slice, check and batch) and with ``window_size`` results a dataset.
    """
    kinds = [(f"_o{i}", "bigint" if tx.type_of(stream, c).typeName() in ("byte", "short", "integer", "long") else "string") for i, c in enumerate(order_by[1:])]
    moment = tx.field(time_column).cast("timestamp")
    order = [F.coalesce(tx.field(c).cast(k), F.lit(-(2**63) if k == "bigint" else "")).alias(n) for (n, k), c in zip(kinds, order_by[1:], strict=True)]
    keys = [f"_k{i}" for i in range(len(by))]
    rows = stream.select(
        *[tx.field(k).cast("string").alias(n) for k, n in zip(by, keys, strict=True)],
        F.pmod(F.xxhash64(*[tx.field(c) for c in order_by]), F.lit(slices)).cast("int").alias("_slice"),
        moment.alias("_time"),
        F.unix_micros(moment).alias("_at"),
        *order,
        F.when(tx.is_true(tx.field(failed)), 1).otherwise(0).cast("bigint").alias("_failed"),
        (F.lit(False) if heartbeat is None else tx.is_true(heartbeat)).alias("_beat"),
    )
    timed = rows.where("_time IS NOT NULL").withWatermark("_time", f"{delay_seconds} seconds")
    # the event time in the condition keeps it above the watermark, which heartbeats must reach
    timed = timed.where("NOT _beat OR _time IS NULL")
    results = ", ".join(["_at bigint", *[f"{n} {k}" for n, k in kinds], "_failed bigint"])
    names = ", ".join(f"{k} string" for k in keys)
    grouped = timed.drop("_beat").groupBy(*keys, "_slice")
    # key columns and the event time come before the results
    closed = grouped.transformWithStateInPandas(
        _Slices(results, len(keys) + 2, window_size, check_seconds),
        outputStructType=f"{names}, _slice int, _mark timestamp, _check bigint, {results}",
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="_mark",
    )
    alerts = closed.groupBy(*keys).transformWithStateInPandas(
        _Datasets(results, len(keys) + 2, window_size, threshold, minimum_samples, cooldown_seconds),
        outputStructType=f"{names}, _check bigint, recent_samples bigint, recent_failures bigint, failure_rate double",
        outputMode="Append",
        timeMode="None",
    )
    kind = lambda name: tx.type_of(stream, name)
    return alerts.select(
        *[F.col(n).cast(kind(k) if not isinstance(kind(k), T.NullType) else "string").alias(k) for n, k in zip(keys, by, strict=True)],
        F.timestamp_seconds("_check").alias("alert_time"),
        "recent_samples",
        "recent_failures",
        "failure_rate",
        severity(F.col("failure_rate"), threshold).alias("severity"),
    )


def keyed_alert_stream(stream: DataFrame, *, path: str, checkpoint: str, trigger: dict | None = None, **options: Any) -> StreamingQuery:
    """Write :func:`keyed_alerts` (its arguments are ``options``) to a parquet table, each alert once.

    The state is in RocksDB, with the checkpoint; a query that starts again on it goes on where it was.
    """
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        alerts = keyed_alerts(stream, **options)
        writer = alerts.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or AVAILABLE_NOW)).start()
    finally:
        spark.conf.set(PROVIDER, before)
