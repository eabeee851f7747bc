"""What one filter step does to a DataFrame, kept declarative so that it can be guarded.

A step is described by an :class:`Effect`: columns to set, columns to drop, a row condition and
an optional explode.  Applying the effect gives the plain operator; guarding it by a condition
first gives conditional steps and audited chains.  Either way the result is one lazy plan.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .records import resolved


@dataclass(frozen=True)
class Effect:
    """Outcome of one step on ``df`` (which may already carry helper columns ``temps``)."""

    df: DataFrame
    sets: dict[str, Column] = field(default_factory=dict)
    drops: tuple[str, ...] = ()
    keep: Column | None = None
    explode: tuple[str, Column] | None = None
    applied: Column = field(default_factory=lambda: F.lit(True))
    temps: tuple[str, ...] = ()
    # For steps that are easier to say as a DataFrame function.  ``local`` ones only edit columns.
    whole: Callable[[DataFrame], DataFrame] | None = None
    local: bool = False

    def run(self) -> DataFrame:
        df = self.df
        if self.whole is not None:
            return self.whole(df)
        if self.keep is not None:
            df = df.where(self.keep)
        if self.sets:
            df = df.withColumns(self.sets)
        if self.explode is not None:
            target, items = self.explode
            df = df.withColumn(target, F.explode(items))
        gone = [name for name in (*self.drops, *self.temps) if name in df.columns]
        return df.drop(*gone) if gone else df


def guarded(effect: Effect, condition: Column, keep_old: bool = True) -> Effect:
    """The same effect only for rows where ``condition`` is true.

    Other rows keep their values (``keep_old``) or, where a column changes its type and the old
    value is not needed any more, get NULL.  A dropped column becomes NULL for guarded rows.
    """
    condition = tx.is_true(condition)
    df = effect.df
    sets: dict[str, Column] = {}
    for name, value in effect.sets.items():
        if not tx.has(df, name):
            sets[name] = F.when(condition, value)
            continue
        new_type = df.select(value.alias("v")).schema["v"].dataType
        old_type = tx.type_of(df, name)
        old = tx.field(name)
        if new_type != old_type:
            old = old.try_cast(new_type) if keep_old and castable(old_type, new_type) else F.lit(None)
        sets[name] = F.when(condition, value).otherwise(old)
    drops = []
    for name in effect.drops:
        if not tx.has(df, name):
            continue
        if keep_old:
            sets[name] = F.when(~condition, tx.field(name))
        else:
            drops.append(name)
    explode = effect.explode
    if explode is not None:
        target, items = explode
        element = df.select(items.alias("v")).schema["v"].dataType.elementType
        same = tx.has(df, target) and tx.type_of(df, target) == element
        single = tx.field(target) if same else F.lit(None).cast(element)
        explode = (target, F.when(condition, items).otherwise(F.array(single)))
    keep = None if effect.keep is None else ~condition | effect.keep
    whole = effect.whole
    if whole is not None and effect.local:
        whole = _guard_columns(whole, condition, keep_old)
    elif whole is not None:
        whole = _guard_rows(whole, condition)

    return replace(
        effect,
        sets=sets,
        drops=tuple(drops),
        keep=keep,
        explode=explode,
        whole=whole,
        applied=condition & tx.is_true(effect.applied),
    )


def _guard_columns(inner, condition: Column, keep_old: bool):
    """Run a column-editing function once and put the old values back where the guard is false."""

    def run(df: DataFrame) -> DataFrame:
        saved = {f"_old_{n}": n for n in df.columns}
        marked = df.withColumns({**{o: tx.field(n) for o, n in saved.items()}, "_guard": condition})
        after = inner(marked)
        guard = tx.field("_guard")
        columns = []
        for name in after.columns:
            if name == "_guard" or name in saved:
                continue
            new, old_name = tx.field(name), f"_old_{name}"
            if old_name not in saved:
                columns.append(F.when(guard, new).alias(name))
                continue
            new_type, old_type = tx.type_of(after, name), tx.type_of(after, old_name)
            old = tx.field(old_name)
            if new_type != old_type:
                old = old.try_cast(new_type) if keep_old and castable(old_type, new_type) else F.lit(None)
            columns.append(F.when(guard, new).otherwise(old).alias(name))
        if keep_old:
            gone = [(o, n) for o, n in saved.items() if n not in after.columns]
            columns += [F.when(~guard, tx.field(o)).alias(n) for o, n in gone]
        return after.select(columns)

    return run


def _guard_rows(inner, condition: Column):
    """Run an arbitrary DataFrame function on the guarded rows only."""

    def run(df: DataFrame) -> DataFrame:
        marked = df.withColumn("_guard", condition)
        inside = inner(marked.where("_guard").drop("_guard"))
        return inside.unionByName(marked.where("NOT _guard").drop("_guard"), allowMissingColumns=True)

    return run


def castable(old, new) -> bool:
    from pyspark.sql import types as T

    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return not isinstance(old, nested) and not isinstance(new, nested)


Builder = Callable[..., Effect]
BUILDERS: dict[str, Builder] = {}


def operator(name: str):
    """Register a step builder under its type name and return the plain DataFrame operator."""

    def register(builder: Builder):
        @functools.wraps(builder)
        def build(df: DataFrame, **config) -> Effect:
            df, extra = resolved(df, name, config)
            effect = builder(df, **config)
            return replace(effect, temps=(*effect.temps, *extra)) if extra else effect

        BUILDERS[name] = build

        @functools.wraps(builder)
        def run(df: DataFrame, **config) -> DataFrame:
            return build(df, **config).run()

        run.build = build
        return run

    return register


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a helper column whose (costly) expression is evaluated exactly once per row.

    The optimizer copies a projected expression into every later filter and projection that uses it;
    it does not do so with the output of an explode, here of a one-element array.
    """
    # Computed by a projection of its own, which shares common parts of the expression.
    return df.withColumn("_once", value).withColumn(name, F.explode(F.array("_once"))).drop("_once")


def unchanged(df: DataFrame) -> Effect:
    return Effect(df, applied=F.lit(False))


def require(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)
