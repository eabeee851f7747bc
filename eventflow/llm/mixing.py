"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, broadcast_if_small, partitions, quoted, running, store, without

# Weight schedules over training time 0..1 as (time, weight) knots, dealt to the sources in turn.
# Their means are the weights of the contract, 3, 1 and 2; the first fades, the second grows.
SCHEDULES: tuple[tuple[tuple[float, float], ...], ...] = (
    ((0.0, 4.0), (1.0, 2.0)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 2.0), (1.0, 2.0)),
)
SHARE, CAP = 1.5, 2
# Documents larger than this part of their source go first, by size: so a cut falls between small ones.
LARGE = 0.002

OUTPUT = ("size", "source_size", "target", "copies", "taken", "positions")


def integral(schedule: Sequence[tuple[float, float]]) -> float:
    """Mean weight of a piecewise linear schedule over 0..1."""
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:], strict=False))


def inverse_demand(schedule: Sequence[tuple[float, float]], part: Column) -> Column:
    """Training time at which a source has had ``part`` (0..1) of its demand: the inverse of the integrated schedule."""
    total, done, out = integral(schedule), 0.0, None
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        slope = (w1 - w0) / (t1 - t0)
        rest = (part - F.lit(done)) * F.lit(total)
        speed = F.lit(w0) + F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + 2 * slope * rest))
        at = F.lit(t0) + F.when(speed > 0, 2 * rest / speed).otherwise(F.lit(0.0))
        at = F.least(F.lit(t1), F.greatest(F.lit(t0), at))
        done += (t1 - t0) * (w0 + w1) / 2 / total
        out = at if out is None else F.when(part < F.lit(lower), out).otherwise(at)
        lower = done
    return out


def source_targets(
    sizes: DataFrame, schedules: Sequence[Sequence[tuple[float, float]]], share: float, cap: int
) -> DataFrame:
    """``source, source_size, turn, target`` from ``source, source_size``.

    Targets are ``min(cap * size, level * weight)``: with one level for all, the excess of capped sources is
    reshared by weight.  With the sources sorted by ``cap * size / weight``, the level is settled by the first
    source that it does not cap.  Both orders are running totals, so no task sees all sources.
    """
    n, weights = len(schedules), [integral(s) for s in schedules]
    sizes = sizes.withColumn("__one", F.lit(1).cast("long"))
    ranked = running(sizes, [F.col("source").asc_nulls_last()], {"__rank": "__one"}, "sources")
    ranked = ranked.withColumn("turn", (F.col("__rank") % n).cast("int"))
    # weights in millionths, so that their totals are whole numbers
    weight = F.element_at(F.array(*[F.lit(round(w * 1_000_000)) for w in weights]), F.col("turn") + 1).cast("long")
    ranked = ranked.withColumns({"__weight": weight, "__cap": F.col("source_size") * cap})
    ratio = F.col("__cap") / F.col("__weight")
    order = [ratio.asc(), F.col("__rank").asc()]
    sorted_ = running(ranked, order, {"__caps": "__cap", "__weights": "__weight"}, "levels")
    sums = sorted_.agg(F.sum("source_size").alias("size"), F.sum("__weight").alias("weight")).first()
    level = (F.lit((sums["size"] or 0) * share) - F.col("__caps")) / (F.lit(sums["weight"]) - F.col("__weights"))
    levels = sorted_.select("__rank", ratio.alias("__ratio"), level.alias("__level"))
    by_ratio = F.min_by("__level", F.struct("__ratio", "__rank"))
    found = levels.filter(F.col("__level") <= F.col("__ratio")).agg(by_ratio).first()[0]
    target = F.col("__cap").cast("double")
    if found is not None:
        target = F.least(target, F.lit(found) * F.col("__weight"))
    return sorted_.select("source", "source_size", "turn", target.alias("target"))


def mix(
    docs: DataFrame,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    share: float = SHARE,
    cap: int = CAP,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Decide what the mix takes of each document: the columns of ``docs`` and ``OUTPUT``.

    ``copies`` (0 to ``cap``) says how often a document is taken, ``positions`` holds the training time (0..1) of each copy.
    A source is laid out in an order that depends on its rows alone and taken up to its target, around again
    while that is beyond its size; a document is taken if its middle lies below the target, so the words taken
    miss the target by half a document at most.

    A null text has size 0 and is taken with what lies beside it.  A null source is a source, the last one.  Rows that are equal
    in all of doc_id, text and source are laid out side by side.  An empty table gives an empty table.  Columns of
    the input named as in ``OUTPUT`` are replaced.
    """
    docs = without(docs, *OUTPUT) if keep is None else docs
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sizes = docs.groupBy("source").agg(F.coalesce(F.sum(words), F.lit(0)).alias("source_size"))
    targets = broadcast_if_small(store(source_targets(sizes, schedules, share, cap), "targets"))
    s = targets.select(*[F.col(c).alias(f"__{c}") for c in targets.columns])

    columns = docs.columns if keep is None else list(keep)
    print_ = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    rows = docs.withColumns({"size": words, "__print": print_}).select(
        *quoted(list(dict.fromkeys([*columns, "source", "doc_id"]))), "size", "__print"
    )
    rows = rows.join(s, F.col("source").eqNullSafe(F.col("__source")))
    first = F.when(F.col("size") > F.col("__source_size") * LARGE, -F.col("size")).otherwise(F.lit(0))
    rows = rows.withColumn("__first", first)
    order = [F.col("source").asc_nulls_last(), F.col("__first").asc(), F.col("__print").asc(), F.col("doc_id").asc()]
    laid = running(rows, order, {"__at": "size"}, "laid")
    starts = store(laid.groupBy("source").agg(F.min("__at").alias("__start")), "starts")
    starts = broadcast_if_small(starts).withColumnRenamed("source", "__of")
    laid = laid.join(starts, F.col("source").eqNullSafe(F.col("__of")))

    middle = F.col("__at") - F.col("__start") + F.col("size") / 2
    rounds = F.array(*[F.col("__source_size") * k + middle for k in range(cap)])
    taken = F.filter(rounds, lambda x: x <= F.col("__target"))
    target = F.col("__target")

    def place(x: Column) -> Column:
        part = F.when(target > 0, x / target).otherwise(F.lit(0.0))
        out = F.lit(None).cast("double")
        for turn, schedule in enumerate(schedules):
            out = F.when(F.col("__turn") == turn, inverse_demand(schedule, part)).otherwise(out)
        return out

    return laid.withColumn("__taken", taken).select(
        *quoted(columns),
        "size",
        F.col("__source_size").alias("source_size"),
        target.alias("target"),
        F.size("__taken").alias("copies"),
        (F.col("size") * F.size("__taken")).alias("taken"),
        F.transform("__taken", place).alias("positions"),
    )


def in_training_order(mixed: DataFrame) -> DataFrame:
    """A row for each copy taken, range-sorted by training time; the columns of ``OUTPUT`` give way to ``position``."""
    columns = [c for c in mixed.columns if c not in OUTPUT]
    copies = mixed.select(*quoted(columns), F.explode("positions").alias("position"))
    return copies.repartitionByRange(partitions(mixed.sparkSession), "position", "doc_id").sortWithinPartitions(
        "position", "doc_id"
    )
