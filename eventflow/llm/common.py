"""What the operators share: shared-folder tables, checked broadcasts, running totals over a global order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.session import scratch_dir

T_ = TypeVar("T_")

# Fixed value: the words of the contracts, as a pattern of Java and of Python.
WORD = r"[^\x20\x09-\x0D]+"
# Most rows of a side that is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def scratch(spark: SparkSession, name: str, make: Callable[[str], T_]) -> T_:
    """What ``make`` returns for a new shared folder that it writes to; the folder goes when the driver's JVM ends."""
    path = scratch_dir(spark, f"llm-{name}")
    made = make(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return made


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back, which cuts its lineage.

    The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession

    def write(path: str) -> str:
        df.write.option("compression", "zstd").parquet(path)
        return path

    path = scratch(spark, name, write)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of what earlier jobs left on the driver: plans, broadcasts and shuffles that nothing refers to any more.

    Spark drops the broadcasts and shuffle files of a finished job only when the driver's JVM collects its garbage.  That JVM takes new
    memory before it does so, and keeps what it took; so a run of many small jobs holds far more than it uses.
    """
    spark._jvm.java.lang.System.gc()


def broadcast_if_small(stored: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of narrow rows with a broadcast hint if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(stored) if stored.count() <= rows else stored


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns of these names, in any case, so that new ones can take their place."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def running(df: DataFrame, order: list[Column], values: dict[str, str], name: str) -> DataFrame:
    """Add, for each ``{new: column}``, the total of a long column over all earlier rows of ``order``.

    The rows are range-partitioned, summed up inside their ranges, stored, and then moved by the totals
    of the ranges before theirs; those are as many rows as there are partitions.  No task gets more
    than its range.  ``order`` must tell any two different rows apart; then a retried task gives the same.
    """
    spark = df.sparkSession
    # deal by keys of one row's width: the order columns are set before, so that ties stay ties
    ranged = df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    columns = list(values.values())
    fields = [T.StructField("__part", T.IntegerType()), *[T.StructField(f"__{n}", T.LongType()) for n in values]]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), dict.fromkeys(columns, 0)
        for batch in batches:
            out = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32))]
            for column in columns:
                each = batch.column(column).to_numpy(zero_copy_only=False)
                total = np.cumsum(each) + before[column]
                out.append(pa.array(total - each))
                before[column] = int(total[-1]) if len(total) else before[column]
            yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names, *[f.name for f in fields]])

    table = store(ranged.mapInArrow(sums, T.StructType([*df.schema.fields, *fields])), name)
    # as many rows as partitions, which the session bounds
    totals = table.groupBy("__part").agg(*[F.sum(f"`{c}`").alias(n) for n, c in values.items()]).collect()
    at, offsets = dict.fromkeys(values, 0), []
    for row in sorted(totals, key=lambda r: r["__part"]):
        offsets.append((row["__part"], *at.values()))
        at = {n: at[n] + row[n] for n in at}
    moved = spark.createDataFrame(offsets, "__part int, " + ", ".join(f"__from_{n} bigint" for n in values))
    joined = table.join(F.broadcast(moved), "__part")
    kept = [F.col(f"`{c}`") for c in df.columns]
    return joined.select(*kept, *[(F.col(f"__{n}") + F.col(f"__from_{n}")).alias(n) for n in values])


def quoted(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]
