"""Writers: compressed newline-delimited JSON per dataset, dead letters and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as tx
from ..operators.records import MISTYPED, REST, record_json
from ..session import scratch_dir

PARTITIONS = ("tenant_id", "dataset_id")


def event_line(df: DataFrame, partition_by: tuple[str, ...] = PARTITIONS) -> Column:
    """JSON text of a row without partition and ``_`` columns; a bad line keeps its original text.

    NULL fields are left out, which is what a missing field looks like in the output.  Undeclared members
    and values of another type than declared (``_rest``, ``_mistyped``, VARIANT ``record``) are part of the same flat object.
    """
    line = record_json(df, [c for c in df.columns if c not in partition_by and not c.startswith("_")])
    if tx.has(df, "_error") and tx.has(df, "_raw"):
        line = F.when(F.col("_error").isNotNull(), F.col("_raw")).otherwise(line)
    return line


def event_lines(df: DataFrame, partition_by: tuple[str, ...] = PARTITIONS) -> DataFrame:
    return df.select(*[tx.field(p) for p in partition_by], event_line(df, partition_by).alias("value"))


def write_events(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = PARTITIONS,
    compression: str = "gzip",
    mode: str = "append",
    rebalance: bool = True,
    max_records_per_file: int = 0,
) -> None:
    """Write JSON lines below ``path`` by partition.

    ``rebalance`` merges small files and splits the files of big datasets: Spark evens out the
    partitions, so no dataset is written by one task.  Without it every task writes a file for each of its datasets.
    """
    lines = event_lines(df, partition_by)
    if rebalance:
        lines = lines.hint("rebalance", *partition_by)
    writer = lines.write.mode(mode).option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)


def write_events_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = PARTITIONS,
    compression: str = "gzip",
    trigger: dict | None = None,
) -> StreamingQuery:
    """The same for a stream; the sink's log and the checkpoint make it exactly-once."""
    writer = (
        event_lines(df, partition_by)
        .writeStream.format("text")
        .option("compression", compression)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
    )
    return (writer.partitionBy(*partition_by) if partition_by else writer).start(path)


def failed(df: DataFrame) -> Column:
    """Whether a row carries a decode error or a parse-failure tag."""
    marks = [tx.field(c).isNotNull() for c in ("_error", "_parse_failure") if tx.has(df, c)]
    return tx.any_of(marks)


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and dead-letter rows."""
    bad = failed(df)
    return df.where(~bad), df.where(bad)


def route_errors(
    df: DataFrame, good_path: str, dead_letter_path: str, partition_by: tuple[str, ...] = PARTITIONS, mode: str = "append"
) -> None:
    """Write good events as JSON lines and dead letters, with their reason, as parquet.

    The input is read and decoded once: both sides are written together to a scratch table in two folders, and
    each is written on from its folder.
    """
    letters = [c for c in ("_error", "_parse_failure", "_raw", "_file") if tx.has(df, c)]
    record = record_json(df, [c for c in df.columns if c not in letters and c not in partition_by and c not in (REST, MISTYPED)])
    keys = [tx.field(p) for p in partition_by]
    bad = tx.is_true(failed(df))
    both = df.select(
        *keys,
        *[tx.field(c) for c in letters],
        F.when(bad, record).alias("record"),
        F.when(~bad, event_line(df, partition_by)).alias("value"),
        F.when(bad, "dead").otherwise("good").alias("_side"),
    )
    path = scratch_dir(df.sparkSession, "sides")
    both.write.partitionBy("_side").parquet(path)
    sides = df.sparkSession.read.schema(both.schema).parquet(path)
    lines = sides.where("_side = 'good'").select(*keys, "value").write.mode(mode).option("compression", "gzip")
    (lines.partitionBy(*partition_by) if partition_by else lines).text(good_path)
    sides.where("_side = 'dead'").drop("_side", "value").write.mode(mode).parquet(dead_letter_path)


def manifest(
    audited: DataFrame,
    pipeline_id: str,
    by: tuple[str, ...] = PARTITIONS,
    file_column: str = "_file",
) -> DataFrame:
    """One row per source file and dataset: format, input and output records, pipeline and time."""
    skipped = tx.is_true(F.col("_skipped")) if tx.has(audited, "_skipped") else F.lit(False)
    name = F.element_at(F.split(tx.field(file_column), "/"), -1)
    counts = audited.groupBy(tx.field(file_column).alias("source_file"), *[tx.field(k) for k in by], name.alias("source_name")).agg(
        F.count("*").alias("input_records"), F.count_if(~skipped).alias("output_records")
    )
    return counts.select(
        "source_file",
        "source_name",
        *by,
        F.lit("ndjson").alias("format"),
        "input_records",
        "output_records",
        F.lit(pipeline_id).alias("pipeline_id"),
        tx.rfc3339_now().alias("processed_at"),
    )


def write_manifest(audited: DataFrame, path: str, pipeline_id: str, mode: str = "append", **options) -> None:
    manifest(audited, pipeline_id, **options).write.mode(mode).parquet(path)
