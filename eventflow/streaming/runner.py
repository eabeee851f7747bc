"""Filter chains and running metrics over streams."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as tx
from ..plans.chain import run_pipeline
from ..plans.spec import ChainSpec, as_spec
from ..sources.sinks import PARTITIONS, event_lines, write_events_stream

AVAILABLE_NOW = {"availableNow": True}


def per_batch(spec: ChainSpec | dict | str | list | None) -> bool:
    """Whether a chain has a step that joins back its own rows, which only a batch can."""
    return spec is not None and any(f.type == "useragent" and f.config.get("distinct") for f in as_spec(spec).active)


def run_stream(
    stream: DataFrame,
    spec: ChainSpec | dict | str | list | None,
    path: str,
    checkpoint: str,
    tables: dict[str, DataFrame] | None = None,
    partition_by: tuple[str, ...] = PARTITIONS,
    trigger: dict | None = None,
    batches: bool = False,
    **context: Any,
) -> StreamingQuery:
    """Run a chain over a stream of events and write JSON lines.

    The chain and its stream-static joins compile into the streaming plan; the file sink's log makes the output
    exactly-once.  With ``batches`` every micro-batch runs on its own and writes the folder
    ``batch=N``, which a repeated batch overwrites; only then can a chain have a step that joins back its own rows.  Nothing else decides
    the layout, so a path is written in one way for good.
    """
    if not batches:
        if per_batch(spec):
            raise ValueError("this chain joins back its own rows: run it with batches=True")
        return write_events_stream(
            run_pipeline(stream, spec, tables, **context), path, checkpoint, partition_by, trigger=trigger
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        # a step that joins back its own rows reads them more than once; they are decoded once
        again = per_batch(spec)
        batch = batch.persist() if again else batch
        try:
            out = event_lines(run_pipeline(batch, spec, tables, **context), partition_by)
            writer = out.write.mode("overwrite").option("compression", "gzip")
            writer.partitionBy(*partition_by).text(f"{path}/batch={batch_id}")
        finally:
            if again:
                batch.unpersist()

    return start(stream, write, checkpoint, trigger)


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def refreshing_stream(
    stream: DataFrame,
    load_spec: Callable[[], Any],
    load_tables: Callable[[], dict[str, DataFrame]],
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = PARTITIONS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Re-read the specification and the look-up tables for every micro-batch.

    A batch sees one consistent version of both; a change takes effect with the next batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = event_lines(run_pipeline(batch, load_spec(), load_tables()), partition_by)
        writer = out.write.mode("overwrite").option("compression", "gzip")
        writer.partitionBy(*partition_by).text(f"{path}/batch={batch_id}")

    return start(stream, write, checkpoint, trigger)


def running_metrics(
    stream: DataFrame,
    time_column: str,
    error_column: str = "_error",
    skipped_column: str = "_skipped",
    by: tuple[str, ...] = PARTITIONS,
) -> DataFrame:
    """Running totals per dataset (reduced per task before the state is touched).

    The last error is the one with the latest event time, in whatever order the batches bring them; of errors at the same time the
    last by text.  ``avg_rows_per_sec`` is over the time between the first and the last event.
    """
    failed = tx.field(error_column).isNotNull() if tx.has(stream, error_column) else F.lit(False)
    skipped = tx.is_true(tx.field(skipped_column)) if tx.has(stream, skipped_column) else F.lit(False)
    at = tx.field(time_column)
    error = tx.field(error_column) if tx.has(stream, error_column) else F.lit(None).cast("string")
    last_error = F.max_by(error, F.when(failed, F.struct(at.alias("at"), error.alias("text"))))
    stamp = at.cast("timestamp")
    seconds = (F.unix_micros(F.max(stamp)) - F.unix_micros(F.min(stamp))) / 1e6
    return stream.groupBy(*[tx.field(k) for k in by]).agg(
        F.count("*").alias("total_processed"),
        F.count_if(~failed & ~skipped).alias("success_count"),
        F.count_if(failed).alias("error_count"),
        F.count_if(skipped & ~failed).alias("skipped_count"),
        last_error.alias("last_error"),
        F.max(at).alias("last_processed"),
        F.when(seconds > 0, F.count("*") / seconds).alias("avg_rows_per_sec"),
    )


def metrics_stream(
    stream: DataFrame, path: str, checkpoint: str, time_column: str, trigger: dict | None = None, **columns: Any
) -> StreamingQuery:
    """Keep a parquet table of the running counters, one folder per report.

    Every report holds the datasets that changed; the newest row of a dataset is its state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("report", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    counters = running_metrics(stream, time_column, **columns)
    writer = counters.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def latest_metrics(reports: DataFrame, by: tuple[str, ...] = PARTITIONS) -> DataFrame:
    """Newest state of every dataset out of the reports."""
    columns = [c for c in reports.columns if c not in (*by, "report", "batch")]
    newest = reports.groupBy(*[tx.field(k) for k in by]).agg(
        F.max_by(F.struct(*[tx.field(c) for c in columns]), "report").alias("s")
    )
    return newest.select(*[tx.field(k) for k in by], "s.*")
