"""Run a filter chain, plainly or audited, and route datasets to their chains."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.effect import guarded
from ..operators.records import in_condition, opened, record_json, with_members
from .spec import ChainSpec, as_spec, build_effect, default_spec

AUDIT_COLUMNS = ("_input", "_output", "_applied", "_skipped", "_skipped_by", "_error")


def run_pipeline(
    df: DataFrame,
    spec: ChainSpec | dict | str | list | None,
    tables: dict[str, DataFrame] | None = None,
    **context: Any,
) -> DataFrame:
    """Apply the enabled filters in order.

    ``None`` stands for the default chain.  Rows with a decode ``_error`` pass through untouched.  A field that is no
    column is looked up among the undeclared members of the record (``_rest``, or a VARIANT ``record``).
    """
    chain = default_spec() if spec is None else as_spec(spec)
    df = opened(df)
    for filter_spec in chain.active:
        df, extra = with_members(df, in_condition(filter_spec.condition or ""), as_text=True, keep=True)
        effect = build_effect(df, filter_spec, tables, context)
        guards = []
        if filter_spec.condition:
            guards.append(F.expr(filter_spec.condition))
        if tx.has(df, "_error"):
            guards.append(F.col("_error").isNull())
        for guard in guards[1:]:
            guards[0] = guards[0] & guard
        df = (guarded(effect, guards[0]) if guards else effect).run().drop(*extra)
    return df


def _record_json(df: DataFrame):
    return record_json(df, [c for c in df.columns if not c.startswith("_")])


def run_pipeline_audited(
    df: DataFrame,
    spec: ChainSpec | dict | str | list | None,
    tables: dict[str, DataFrame] | None = None,
    max_filters: int | None = None,
    **context: Any,
) -> DataFrame:
    """Like :func:`run_pipeline`, but every row stays and tells what happened to it.

    Adds ``_input`` and ``_output`` (JSON of the record before the chain and when it left it), ``_applied``
    (filter types that took effect), ``_skipped``, ``_skipped_by`` and ``_error``.  ``max_filters`` refuses longer chains.
    """
    chain = default_spec() if spec is None else as_spec(spec)
    active = chain.active
    if max_filters is not None and len(active) > max_filters:
        raise ValueError(f"at most {max_filters} filters can be audited")
    df = opened(df)
    error = F.col("_error") if tx.has(df, "_error") else F.lit(None).cast("string")
    df = df.withColumns(
        {
            "_input": _record_json(df),
            "_applied": F.array().cast("array<string>"),
            "_skipped": F.lit(False),
            "_skipped_by": F.lit(None).cast("string"),
            "_output": F.lit(None).cast("string"),
            "_error": error,
        }
    )
    for filter_spec in active:
        live = ~F.col("_skipped") & F.col("_error").isNull()
        if filter_spec.condition:
            live = live & tx.is_true(F.expr(filter_spec.condition))
        effect = guarded(build_effect(df, filter_spec, tables, context), live, keep_old=bool(filter_spec.condition))
        prepared = effect.df
        skip = F.lit(False) if effect.keep is None else live & ~tx.is_true(effect.keep)
        marks = {"_hit": effect.applied, "_skip": skip}
        prepared = prepared.withColumns(marks)
        prepared = prepared.withColumns(
            {
                "_applied": F.when(
                    F.col("_hit"), F.array_append("_applied", F.lit(filter_spec.type))
                ).otherwise(F.col("_applied")),
                "_output": F.when(F.col("_skip"), _record_json(df)).otherwise(F.col("_output")),
                "_skipped_by": F.when(F.col("_skip"), F.lit(filter_spec.type)).otherwise(F.col("_skipped_by")),
            }
        )
        # The guard of the edits still looks at the old flag, so that is updated last.
        edited = _edit(effect, prepared)
        df = edited.withColumn("_skipped", F.col("_skipped") | F.col("_skip")).drop("_hit", "_skip")
    final = F.coalesce(F.col("_output"), F.when(F.col("_error").isNull(), _record_json(df)))
    return df.withColumn("_output", final)


def _edit(effect, prepared: DataFrame) -> DataFrame:
    from dataclasses import replace

    return replace(effect, df=prepared, keep=None).run()


def preview(
    df: DataFrame, spec, order_by: str, count: int = 100, tables: dict[str, DataFrame] | None = None, **context: Any
) -> DataFrame:
    """Audited run over the first ``count`` rows (100 if that is not positive)."""
    count = 100 if count <= 0 else count
    return run_pipeline_audited(df.orderBy(tx.field(order_by)).limit(count), spec, tables, **context)


def route(
    df: DataFrame,
    specs: dict[tuple[str, str], Any],
    tables: dict[str, DataFrame] | None = None,
    fallback: Any = None,
    keys: tuple[str, str] = ("tenant_id", "dataset_id"),
) -> DataFrame:
    """Run every (tenant, dataset) through its own chain; others take ``fallback`` (default chain).

    Datasets with the same specification share one branch.  Branches differ in a plain condition on
    the two keys, so a table partitioned by them is read once in all: each branch reads its own files.
    """
    tenant, dataset = (tx.field(k) for k in keys)

    def among(members) -> Column:
        by_tenant: dict[str, list[str]] = {}
        for t, d in members:
            by_tenant.setdefault(t, []).append(d)
        return reduce(lambda a, b: a | b, [(tenant == t) & dataset.isin(d) for t, d in by_tenant.items()], F.lit(False))

    branches: list[tuple[ChainSpec, list[tuple[str, str]]]] = []
    for key, source in specs.items():
        spec = as_spec(source)
        same = next((b for b in branches if b[0].filters == spec.filters and b[0].enabled == spec.enabled), None)
        if same is None:
            branches.append((spec, [key]))
        else:
            same[1].append(key)
    routed = []
    for spec, members in branches:
        routed.append(run_pipeline(df.where(among(members)), spec, tables))
    others = tenant.isNull() | dataset.isNull() | ~among(specs)
    routed.append(run_pipeline(df.where(others), fallback, tables))
    result = routed[0]
    for other in routed[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
