"""Good rows and dead letters of a stream, each row once on its side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import PARTITIONS, route_errors
from .files import names, write_once
from .runner import start

GOOD, DEAD, COMMITS = "good", "dead", "commits"


def route_errors_stream(
    stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = PARTITIONS, trigger: dict | None = None
) -> StreamingQuery:
    """Split every micro-batch with :func:`eventflow.route_errors`, into folders of its own below ``path``.

    ``good/batch=N`` has JSON lines and ``dead/batch=N`` parquet; a batch that runs again overwrites both.  When both are complete
    the marker ``commits/N`` is written, and :func:`committed` reads marked batches only.  So whatever moment a run is killed at, a
    reader sees each row once on its side, or not yet on either.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        sides = [f"{path}/{side}/batch={batch_id}" for side in (GOOD, DEAD)]
        route_errors(batch, *sides, partition_by=partition_by, mode="overwrite")
        write_once(batch.sparkSession, f"{path}/{COMMITS}/{batch_id}", "")

    return start(stream, write, checkpoint, trigger)


def committed(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The folders of good rows and of dead letters of all committed batches."""
    batches = sorted(int(n) for n in names(spark, f"{path}/{COMMITS}"))
    return tuple([f"{path}/{side}/batch={n}" for n in batches] for side in (GOOD, DEAD))
