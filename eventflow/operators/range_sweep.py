"""The narrowest range around each of many points, by one sweep over both in order.

Points, range starts and range ends are dealt to partitions by position, so a dense stretch of the axis is spread like any
other.  Inside a partition a heap holds the open ranges, the narrowest on top.  What is open where a partition
begins comes from the ranges of earlier partitions: of those that go on beyond it only the narrowest, of those that
end inside it the narrowest for each end.  No task gets more than about its share of points and range borders, and the driver
gets a few rows for each partition.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

START, POINT, END = 0, 1, 2


def _width(start: bytes, end: bytes) -> bytes:
    return (int.from_bytes(end) - int.from_bytes(start)).to_bytes(len(end))


def _spans(firsts: list[bytes]):
    """For each range that goes on into later partitions: the copy where it ends, and two stretches of partitions that it covers.

    ``level`` is -1 for a copy, else the stretch has ``2 ** level`` partitions from ``part`` on; two of them, which may overlap,
    make up any number of partitions.
    """

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for part, start, end in zip(*[batch.column(c).to_pylist() for c in ("part", "key", "end")], strict=True):
                last = bisect_right(firsts, end) - 1
                if last <= part:
                    continue
                width = _width(start, end)
                out.append((-1, last, width, start, end))
                covered = last - part - 1
                if covered:
                    level = covered.bit_length() - 1
                    out.append((level, part + 1, width, start, end))
                    out.append((level, last - (1 << level), width, start, end))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["level", "part", "width", "key", "end"])

    return spans


def _covers(stretches: list, parts: int) -> list[tuple[int, bytes, bytes]]:
    """The narrowest range that covers each partition, out of the narrowest of each stretch."""
    best = {(r["level"], r["part"]): (r["best"]["width"], r["best"]["key"], r["best"]["end"]) for r in stretches}
    for level in range(parts.bit_length(), 0, -1):
        for at in range(parts):
            mine = best.get((level, at))
            if mine:
                for half in (at, at + (1 << level - 1)):
                    key = (level - 1, half)
                    best[key] = min(best.get(key, mine), mine)
    return [(part, *best[0, part][1:]) for part in range(parts) if (0, part) in best]


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each point with the narrowest range that is open there; a partition's carried ranges come before its rows."""
    at, heap = None, []
    for batch in batches:
        points, starts, ends = [], [], []
        for part, kind, key, end in zip(*[batch.column(c).to_pylist() for c in ("part", "kind", "key", "end")], strict=True):
            if part != at:
                at, heap = part, []
            if kind == START:
                heapq.heappush(heap, (_width(key, end), key, end))
                continue
            while heap and heap[0][2] < key:
                heapq.heappop(heap)
            if heap:
                points.append(key)
                starts.append(heap[0][1])
                ends.append(heap[0][2])
        arrays = [pa.array(c, pa.binary()) for c in (points, starts, ends)]
        yield pa.RecordBatch.from_arrays(arrays, names=["point", "start", "end"])


def narrowest(points: DataFrame, ranges: DataFrame, partitions: int | None = None) -> DataFrame:
    """``point, start, end`` for each point inside some range: the narrowest one, of equally narrow ones the first.

    ``points`` has distinct values ``point``, ``ranges`` distinct pairs ``start, end`` (both inclusive, ``start <= end``); all are binary
    and equally long, and compare bytewise.  Points outside all ranges are missing.
    """
    spark = points.sparkSession
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    row = lambda df, key, kind, other: df.select(F.col(key).alias("key"), F.lit(kind).alias("kind"), other.alias("end"))
    borders = row(ranges, "start", START, F.col("end")).union(row(ranges, "end", END, F.col("start")))
    everything = borders.union(row(points, "point", POINT, F.lit(None).cast("binary")))
    # the ends are there for the balance alone; equal borders can be told apart by the other end
    ranged = everything.repartitionByRange(parts, "key", "kind", "end")
    cut = stored(ranged.where(F.col("key").isNotNull()).withColumn("part", F.spark_partition_id()), "sweep")

    # one row for each partition
    by_part = {r["part"]: r["first"] for r in cut.groupBy("part").agg(F.min("key").alias("first")).collect()}
    numbers = sorted(by_part)
    firsts = [by_part[p] for p in numbers]
    if numbers != list(range(len(numbers))):  # partitions without rows are passed over
        places = spark.createDataFrame(list(enumerate(numbers)), "place int, part int")
        cut = cut.join(F.broadcast(places), "part").select("key", "kind", "end", F.col("place").alias("part"))
    own = cut.where(F.col("kind") != END)

    opened = own.where(F.col("kind") == START).select("part", "key", "end")
    spans = opened.mapInArrow(_spans(firsts), "level int, part int, width binary, key binary, end binary")
    # at most one row for each partition and level, and for each partition and end
    least = F.min(F.struct("width", "key", "end")).alias("best")
    carried = stored(spans.groupBy("level", "part", F.when(F.col("level") < 0, F.col("end")).alias("of")).agg(least), "carried")
    covers = _covers(carried.where("level >= 0").collect(), len(firsts))
    copies = carried.where("level < 0").select("part", F.lit(START).alias("kind"), F.col("best.key").alias("key"), F.col("best.end").alias("end"))
    over = spark.createDataFrame(covers, "part int, key binary, end binary").select("part", F.lit(START).alias("kind"), "key", "end")

    rows = own.select("part", "kind", "key", "end", F.lit(1).alias("own"))
    before = copies.union(over).withColumn("own", F.lit(0))
    placed = rows.unionByName(before).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "own", "key", "kind")
    return placed.select("part", "kind", "key", "end").mapInArrow(_swept, "point binary, start binary, end binary")
