"""Rolling failure rates and threshold alerts per dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

KEY = ("tenant_id", "dataset_id")


def failure_rate(
    df: DataFrame,
    failed: str,
    order_by: tuple[str, ...],
    window_size: int = 100,
    by: tuple[str, ...] = KEY,
    next_of: str | None = None,
) -> DataFrame:
    """Failure percentage over the last ``window_size`` results of the row's dataset.

    Adds ``recent_samples``, ``recent_failures`` and ``failure_rate``.  A dataset may hold most
    of the rows, so no task handles a whole one: rows are range-partitioned by dataset and order,
    and the window is computed inside each range.  The rows near the borders of the ranges (at most
    ``window_size - 1`` on either side, whatever the data size) go through a second window that
    joins the ranges of a dataset up again.  ``next_of`` adds that column of the next result in the same
    range as ``_next``, which lets :func:`check_points` thin the rows without sorting them again.
    """
    reach = window_size - 1
    keys = [tx.field(k) for k in by]
    order = [tx.field(o) for o in order_by]
    fail = F.when(tx.is_true(tx.field(failed)), F.lit(1)).otherwise(F.lit(0))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = (
        df.withColumn("_fail", fail)
        .repartitionByRange(parts, *keys, *order)
        .withColumn("_range", F.spark_partition_id())
    )

    inside = Window.partitionBy("_range", *keys)
    recent = inside.orderBy(*order).rowsBetween(-reach, Window.currentRow)
    marked = ranged.withColumns(
        {
            "_n": F.count("*").over(recent),
            "_f": F.sum("_fail").over(recent),
            "_rn": F.row_number().over(inside.orderBy(*order)),
            "_size": F.count("*").over(inside),
        }
    )
    if next_of:
        marked = marked.withColumn("_next", F.lead(tx.field(next_of)).over(inside.orderBy(*order)))
    head = F.col("_rn") <= reach
    tail = F.col("_rn") > F.col("_size") - reach
    # Border rows of all ranges of a dataset meet in one group, all others keep their range.
    marked = marked.withColumn("_group", F.when(head | tail, F.lit(-1)).otherwise(F.col("_range")))
    border = Window.partitionBy(*keys, "_group").orderBy(*order).rowsBetween(-reach, Window.currentRow)
    joined = marked.withColumns({"_bn": F.count("*").over(border), "_bf": F.sum("_fail").over(border)})
    samples = F.when(F.col("_rn") <= reach, F.col("_bn")).otherwise(F.col("_n"))
    failures = F.when(F.col("_rn") <= reach, F.col("_bf")).otherwise(F.col("_f"))
    return (
        joined.withColumns({"recent_samples": samples, "recent_failures": failures})
        .withColumn("failure_rate", F.col("recent_failures") * 100.0 / F.col("recent_samples"))
        .drop("_fail", "_range", "_n", "_f", "_rn", "_size", "_group", "_bn", "_bf")
    )


def severity(rate: Column, threshold: float) -> Column:
    return F.when(rate >= threshold * 2, "critical").when(rate >= threshold * 1.5, "high").otherwise("medium")


def check_second(time_column: str, check_seconds: int) -> Column:
    """Second of the first check at or after a result."""
    stamp = tx.field(time_column).cast("timestamp")
    return F.ceil(F.unix_micros(stamp) / F.lit(check_seconds * 1000000)).cast("bigint") * check_seconds


def check_points(
    rates: DataFrame, time_column: str, order_by: tuple[str, ...], check_seconds: int, by: tuple[str, ...] = KEY
) -> DataFrame:
    """State of every dataset at each periodic check that follows new results.

    A check sees the last result before it; the reduction to one row per dataset and check is
    an aggregate with partial results.
    """
    check = check_second(time_column, check_seconds)
    if tx.has(rates, "_next"):
        # Only the last result of a check (and of a range) can be the one the check sees.
        rates = rates.where(F.col("_next").isNull() | (check_second("_next", check_seconds) != check))
    last = F.struct(*[tx.field(o) for o in order_by])
    state = F.struct("recent_samples", "recent_failures", "failure_rate")
    checked = rates.groupBy(*[tx.field(k) for k in by], check.alias("check_second")).agg(
        F.max_by(state, last).alias("s")
    )
    return checked.select(*[tx.field(k) for k in by], "check_second", "s.*")


def failure_alerts(
    rates: DataFrame,
    time_column: str,
    order_by: tuple[str, ...],
    threshold: float = 20.0,
    minimum_samples: int = 10,
    cooldown_seconds: int = 1800,
    check_seconds: int = 300,
    by: tuple[str, ...] = KEY,
    last_alerts: DataFrame | None = None,
) -> DataFrame:
    """Alerts of datasets whose failure rate is at or above the threshold when checked.

    Checks happen every ``check_seconds``; after an alert a dataset is silent for
    ``cooldown_seconds``.  ``last_alerts`` (key columns and ``last_second``) continues the silence
    of an earlier run.  A breach that comes ``cooldown_seconds`` or more after the one before fires in any case, so
    the silence is followed inside each stretch of closer breaches on its own; the length of a stretch depends on the time span
    only, not on the number of rows.  The rates are computed once: a breach carries its numbers.
    """
    checks = check_points(rates, time_column, order_by, check_seconds, by)
    breaches = checks.where((F.col("failure_rate") >= threshold) & (F.col("recent_samples") >= minimum_samples))
    keys = [tx.field(k) for k in by]
    in_order = Window.partitionBy(*keys).orderBy("check_second")
    before = F.lag("check_second").over(in_order)
    starts = F.when(before.isNull() | (F.col("check_second") - before >= cooldown_seconds), F.col("check_second"))
    stretched = breaches.withColumn("_starts", starts).withColumn("_stretch", F.max("_starts").over(in_order))
    breach = F.struct("check_second", "recent_samples", "recent_failures", "failure_rate")
    listed = stretched.groupBy(*keys, "_stretch").agg(F.array_sort(F.collect_list(breach)).alias("breaches"))
    if last_alerts is None:
        listed = listed.withColumn("last_second", F.lit(None).cast("bigint"))
    else:
        last = last_alerts.select(*[F.col(k).alias(f"_of_{k}") for k in by], "last_second")
        same = [tx.field(k).eqNullSafe(F.col(f"_of_{k}")) for k in by]
        listed = listed.join(last, same, "left")

    def fold(state: Column, breach: Column) -> Column:
        due = state["last"].isNull() | (breach["check_second"] - state["last"] >= cooldown_seconds)
        fired = F.struct(breach["check_second"].alias("last"), F.array_append(state["alerts"], breach).alias("alerts"))
        return F.when(due, fired).otherwise(state)

    none = F.slice("breaches", 1, 0)
    start = F.struct(F.col("last_second").alias("last"), none.alias("alerts"))
    fired = listed.select(*keys, F.explode(F.aggregate("breaches", start, fold)["alerts"]).alias("a"))
    return fired.select(
        *keys,
        F.timestamp_seconds("a.check_second").alias("alert_time"),
        "a.recent_samples",
        "a.recent_failures",
        "a.failure_rate",
        severity(F.col("a.failure_rate"), threshold).alias("severity"),
    )
