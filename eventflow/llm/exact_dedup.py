"""Exact duplicates: counting quotient filters find repeated fingerprints, whole texts settle them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, store

BITS = 64
# Fingerprints that one block of the merged filter should hold at most.
BLOCK_ROWS = 1_000_000


class QuotientFilter:
    """Counting quotient filter of one block: sorted remainders in runs, one run for each occupied quotient.

    A fingerprint of ``width`` bits is its quotient, the upper bits, and its remainder.  ``occupied`` has a bit
    for each quotient, ``run_end`` one for each slot, so both halves together give the fingerprint back:
    nothing is lost and two filters merge by merging their sorted slots.
    """

    def __init__(self, width: int, quotient: int, occupied: bytes, run_end: bytes, remainders: bytes, counts: bytes):
        self.width, self.quotient = width, quotient
        self.occupied, self.run_end, self.remainders, self.counts = occupied, run_end, remainders, counts

    @classmethod
    def of(cls, sorted_fingerprints: np.ndarray, counts: np.ndarray, width: int) -> QuotientFilter:
        quotient = min(width - 1, max(1, int(len(sorted_fingerprints)).bit_length()))
        below = np.uint64(width - quotient)
        quotients = (sorted_fingerprints >> below).astype(np.int64)
        occupied = np.zeros(1 << quotient, bool)
        occupied[quotients] = True
        run_end = np.append(quotients[1:] != quotients[:-1], True)
        remainders = sorted_fingerprints & ((np.uint64(1) << below) - np.uint64(1))
        return cls(
            width, quotient, np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(),
            remainders.tobytes(), counts.astype(np.int64).tobytes(),
        )

    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints, sorted, and their counts."""
        remainders, counts = np.frombuffer(self.remainders, np.uint64), np.frombuffer(self.counts, np.int64)
        quotients = np.flatnonzero(np.unpackbits(np.frombuffer(self.occupied, np.uint8)))
        ends = np.unpackbits(np.frombuffer(self.run_end, np.uint8), count=len(remainders))
        run = np.cumsum(ends) - ends
        return (quotients[run].astype(np.uint64) << np.uint64(self.width - self.quotient)) | remainders, counts


def merged(filters: list[QuotientFilter]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints of several filters, and their counts added up."""
    slots = [f.slots() for f in filters]
    values, counts = np.concatenate([s[0] for s in slots]), np.concatenate([s[1] for s in slots])
    order = np.argsort(values, kind="stable")  # a merge of sorted runs
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))[: len(values)]
    return values[first], np.add.reduceat(counts, first) if len(values) else counts


FILTER = "block bigint, quotient int, occupied binary, run_end binary, remainders binary, counts binary"


def repeated_fingerprints(prints: DataFrame, block_bits: int | None = None) -> DataFrame:
    """Values of the long column ``fp`` that occur more than once, as ``fp, n``.

    Each partition builds its filter and sends it by blocks of the upper bits; a block of all
    partitions is merged in one task.  A value takes one slot of each filter however often it occurs, so no
    block is hot, and the number of blocks grows with the rows.
    """
    if block_bits is None:
        block_bits = max(5, (prints.count() // BLOCK_ROWS).bit_length())
    width = BITS - block_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = [b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for b in batches]
        prints, counts = np.unique(np.concatenate(values or [np.zeros(0, np.uint64)]), return_counts=True)
        if not len(prints):
            return
        blocks = prints >> np.uint64(width)
        starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
        low = prints & ((np.uint64(1) << np.uint64(width)) - np.uint64(1))
        for a, b in zip(starts, np.append(starts[1:], len(blocks)), strict=True):
            f = QuotientFilter.of(low[a:b], counts[a:b], width)
            yield pa.RecordBatch.from_pydict(
                {"block": [int(blocks[a])], "quotient": pa.array([f.quotient], pa.int32()), "occupied": [f.occupied],
                 "run_end": [f.run_end], "remainders": [f.remainders], "counts": [f.counts]}
            )

    def merge(group: pa.Table) -> pa.Table:
        filters = [
            QuotientFilter(width, r["quotient"], r["occupied"], r["run_end"], r["remainders"], r["counts"])
            for r in group.to_pylist()
        ]
        low, counts = merged(filters)
        block = np.uint64(group.column("block")[0].as_py()) << np.uint64(width)
        often = counts > 1
        return pa.table({"fp": (low[often] | block).view(np.int64), "n": counts[often]})

    return prints.mapInArrow(build, FILTER).groupBy("block").applyInArrow(merge, "fp bigint, n bigint")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``; of equal texts the largest id stays.

    A null text counts as empty.  Rows that share both text and doc_id are all kept or all dropped.  A null
    doc_id stays only where its whole group has none (``keep_id`` is null then).  Other columns are ignored.

    A document whose fingerprint is alone is settled without its text; the others are grouped by their
    text itself, so that a shared fingerprint never joins different texts.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.select("doc_id", "text", F.xxhash64("text").alias("fp"))
    repeated = broadcast_if_small(store(repeated_fingerprints(base.select("fp")), "repeated").select("fp"))
    groups = (
        base.join(repeated, "fp", "left_semi")
        .groupBy("fp", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("fp", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    groups = broadcast_if_small(store(groups, "groups"))
    rows = base.select("doc_id", "fp", F.sha2("text", 256).alias("text_sha256"))
    joined = rows.join(groups, ["fp", "text_sha256"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
