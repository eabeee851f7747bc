"""Specifications and look-up tables of a stream by version: published as snapshots, chosen once for each batch."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as tx
from ..plans.chain import run_pipeline
from ..sources.sinks import PARTITIONS, event_lines
from .files import names, read_text, write_once
from .runner import start

SNAPSHOTS, TABLES, BATCHES = "snapshots", "tables", "batches"


def _print(table: DataFrame) -> str:
    """What tells two contents of a table apart, whatever the order of its rows."""
    row = F.xxhash64(F.to_json(F.struct(*[tx.field(c) for c in table.columns]), {"ignoreNullFields": "false"}))
    sums = table.agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x")).first()
    return f"{table.schema.json()}|{sums['n']}|{sums['s']}|{sums['x']}"


def latest(spark: SparkSession, store: str) -> int:
    """The newest version, 0 if there is none."""
    return max((int(n.removesuffix(".json")) for n in names(spark, f"{store}/{SNAPSHOTS}")), default=0)


def _snapshot(spark: SparkSession, store: str, version: int) -> dict[str, Any]:
    text = read_text(spark, f"{store}/{SNAPSHOTS}/{version}.json")
    if text is None:
        raise ValueError(f"there is no version {version} in {store}")
    return json.loads(text)


def publish(spark: SparkSession, store: str, spec: dict | list, tables: dict[str, DataFrame] | None = None) -> int:
    """Publish a specification and look-up tables as the next version, and return its number.

    A table whose rows are as in the version before keeps its files there.  If nothing has changed, that version stays.  The snapshot is
    written last and whole, so a stream sees all of a version or nothing.
    """
    number = latest(spark, store)
    before = _snapshot(spark, store, number) if number else {"spec": None, "tables": {}}
    kept: dict[str, dict[str, str]] = {}
    for name, table in (tables or {}).items():
        mark, old = _print(table), before["tables"].get(name)
        if old and old["print"] == mark:
            kept[name] = old
            continue
        folder = f"{store}/{TABLES}/{name}/{number + 1}"
        table.write.mode("overwrite").parquet(folder)
        kept[name] = {"folder": folder, "print": mark}
    made = {"spec": spec, "tables": kept}
    if number and made == before:
        return number
    write_once(spark, f"{store}/{SNAPSHOTS}/{number + 1}.json", json.dumps(made))
    return number + 1


class Versions:
    """The version that a running stream uses; tables stay in executor storage until their files change."""

    def __init__(self, store: str):
        self.store, self.number = store, 0
        self.spec: Any = None
        self.folders: dict[str, str] = {}
        self.tables: dict[str, DataFrame] = {}

    def use(self, spark: SparkSession, number: int) -> None:
        """Swap to a version: tables with new files are read again, others stay."""
        if number == self.number:
            return
        made = _snapshot(spark, self.store, number)
        folders = {name: t["folder"] for name, t in made["tables"].items()}
        for name, table in list(self.tables.items()):
            if folders.get(name) != self.folders[name]:
                table.unpersist()
                del self.tables[name]
        for name, folder in folders.items():
            if name not in self.tables:
                self.tables[name] = spark.read.parquet(folder).persist()
        self.spec, self.folders, self.number = made["spec"], folders, number

    def of_batch(self, spark: SparkSession, log: str, batch_id: int) -> int:
        """The version of a batch: the newest at its first try, the same at any other."""
        return int(write_once(spark, f"{log}/{batch_id}", str(latest(spark, self.store))))


def versioned_stream(
    stream: DataFrame,
    store: str,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = PARTITIONS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run the chain that :func:`publish` has put into ``store``, with its look-up tables, on every micro-batch.

    A new version takes effect with the next batch.  The version of each batch is logged beside the checkpoint before the
    batch runs, so a batch that is tried again gives the rows of its first try even if a newer version is there by then.
    """
    versions = Versions(store)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions.use(spark, versions.of_batch(spark, f"{checkpoint}/{BATCHES}", batch_id))
        out = event_lines(run_pipeline(batch, versions.spec, versions.tables), partition_by)
        writer = out.write.mode("overwrite").option("compression", "gzip")
        (writer.partitionBy(*partition_by) if partition_by else writer).text(f"{path}/batch={batch_id}")

    return start(stream, write, checkpoint, trigger)
