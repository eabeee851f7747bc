"""Failure alerts over a stream, with the rolling window carried from batch to batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as tx
from ..operators.alerts import KEY, check_second, failure_alerts, failure_rate
from .runner import start

NEVER = -(2**62)


def _last_results(rows: DataFrame, order: list[str], window_size: int, by: tuple[str, ...]) -> DataFrame:
    """The newest ``window_size - 1`` results per dataset.

    Rows are first cut down per slice of a dataset, so that no task sorts a whole one.
    """
    newest = [F.desc(c) for c in order]
    sliced = rows.withColumn("_slice", F.spark_partition_id())
    for keys in ((*by, "_slice"), by):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
        sliced = sliced.withColumn("_rank", rank).where(F.col("_rank") < window_size).drop("_rank")
    return sliced.drop("_slice")


class _Alerts:
    """Judging of closed checks, and the tables that carry what is open from batch to batch."""

    def __init__(self, path, state_path, order_by, window_size, threshold, minimum_samples, cooldown_seconds, check_seconds, by):
        self.path, self.state, self.by, self.window, self.check = path, state_path, by, window_size, check_seconds
        self.rules = threshold, minimum_samples, cooldown_seconds
        self.order = [f"_o{i}" for i in range(len(order_by))]

    def before(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame | None, DataFrame | None, int]:
        """Rows, last alerts and judged second as the batch before left them; only the first batch has none."""
        if not batch_id:
            return None, None, NEVER
        read = lambda name: spark.read.parquet(f"{self.state}/{name}/batch={batch_id - 1}")
        return read("results"), read("silence"), read("mark").first()["judged"]

    def once(self, fresh: DataFrame, batch_id: int) -> DataFrame:
        path = f"{self.state}/fresh/batch={batch_id}"
        fresh.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return fresh.sparkSession.read.schema(fresh.schema).parquet(path)

    def judge(self, rows: DataFrame, silent: DataFrame | None, judged: int, closed: Column | int, name: str) -> DataFrame:
        """Write the alerts of the checks after ``judged`` up to ``closed``; returns the last alert of each dataset."""
        check = check_second("_at", self.check)
        rated = failure_rate(rows, "_failed", tuple(self.order), self.window, self.by, next_of="_at")
        now = rated.where((check > judged) & (check <= closed))
        threshold, samples, cooldown = self.rules
        alerts = failure_alerts(now, "_at", tuple(self.order), threshold, samples, cooldown, self.check, self.by, silent)
        alerts.write.mode("overwrite").parquet(f"{self.path}/batch={name}")
        fired = rows.sparkSession.read.schema(alerts.schema).parquet(f"{self.path}/batch={name}")
        last = fired.groupBy(*self.by).agg(F.max(F.unix_seconds("alert_time")).alias("last_second"))
        if silent is not None:
            last = last.unionByName(silent).groupBy(*self.by).agg(F.max("last_second").alias("last_second"))
        return last

    def keep(self, spark: SparkSession, batch_id: int, rows: DataFrame, last: DataFrame, closed: int) -> None:
        check = check_second("_at", self.check)
        ring = _last_results(rows.where(check <= closed), self.order, self.window, self.by)
        ring.unionByName(rows.where(check > closed)).write.mode("overwrite").parquet(f"{self.state}/results/batch={batch_id}")
        last.write.mode("overwrite").parquet(f"{self.state}/silence/batch={batch_id}")
        mark = spark.range(1).select(F.lit(closed).cast("bigint").alias("judged"))
        mark.write.mode("overwrite").parquet(f"{self.state}/mark/batch={batch_id}")
        # a repeated batch needs the state before it, and no older one; its own rows it reads anew
        for name, of in (("fresh", batch_id), ("results", batch_id - 2), ("silence", batch_id - 2), ("mark", batch_id - 2)):
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{self.state}/{name}/batch={of}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def alert_stream(
    stream: DataFrame,
    failed: str,
    time_column: str,
    order_by: tuple[str, ...],
    path: str,
    state_path: str,
    checkpoint: str,
    window_size: int = 100,
    threshold: float = 20.0,
    minimum_samples: int = 10,
    cooldown_seconds: int = 1800,
    check_seconds: int = 300,
    by: tuple[str, ...] = KEY,
    delay_seconds: int = 0,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write alerts per micro-batch with the batch operators, as one run over all rows would find them.

    A check is judged once, when a result more than ``delay_seconds`` after it has come; results are ordered by ``order_by``
    (event time first), whatever batch they come in.  So cuts between batches and disorder within the delay change nothing.
    A result that comes later still is counted in the windows after it.  The checks that are open at
    the end of a run stay open; :func:`finish_alerts` judges them.

    State between batches is in ``state_path``: the open results with the ``window_size - 1`` before them of each
    dataset, the last alerts, and the second up to which checks are judged.  A batch reads the tables of the batch before
    it and writes its own, so a repeated batch gives the same result; a batch whose state is missing fails.
    """
    alerts = _Alerts(path, state_path, order_by, window_size, threshold, minimum_samples, cooldown_seconds, check_seconds, by)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.select(
            *[tx.field(k) for k in by],
            tx.is_true(tx.field(failed)).alias("_failed"),
            tx.field(time_column).cast("timestamp").alias("_at"),
            *[tx.field(c).alias(n) for n, c in zip(alerts.order, order_by, strict=True)],
        )
        before, silent, judged = alerts.before(spark, batch_id)
        # the batch is read and decoded once
        fresh = alerts.once(fresh, batch_id)
        rows = fresh if before is None else before.unionByName(fresh)
        latest = fresh.agg(F.max(F.unix_micros("_at"))).first()[0]
        due = NEVER if latest is None else (latest - delay_seconds * 1_000_000 - 1) // (check_seconds * 1_000_000) * check_seconds
        closed = max(judged, due)
        last = alerts.judge(rows, silent, judged, closed, str(batch_id))
        alerts.keep(spark, batch_id, rows, last, closed)

    return start(stream, write, checkpoint, trigger)


def finish_alerts(
    spark: SparkSession,
    last_batch: int,
    path: str,
    state_path: str,
    order_by: tuple[str, ...],
    window_size: int = 100,
    threshold: float = 20.0,
    minimum_samples: int = 10,
    cooldown_seconds: int = 1800,
    check_seconds: int = 300,
    by: tuple[str, ...] = KEY,
) -> None:
    """Judge the checks that the stream left open after ``last_batch``, for a stream that has ended."""
    alerts = _Alerts(path, state_path, order_by, window_size, threshold, minimum_samples, cooldown_seconds, check_seconds, by)
    rows, silent, judged = alerts.before(spark, last_batch + 1)
    alerts.judge(rows, silent, judged, 2**62, str(last_batch + 1))
