"""Route datasets to their chains in one pass: the chains merged to a tree of steps over one input.

Chains that begin with the same steps share them.  A step sees the columns of its own chain, which are NULL in the rows of other
chains, so it costs those rows next to nothing; what it changes becomes a column of that chain.  At the end each row takes its
own chain's columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..operators.effect import Effect, castable, guarded, once
from ..operators.records import MISTYPED, REST, in_condition, is_open, opened, with_members
from .spec import ChainSpec, FilterSpec, as_spec, build_effect, default_spec

CHAIN, GUARD, HELD = "_route_chain", "_route_guard", "_route_"


@dataclass
class _Node:
    """A step that some chains share, and the steps after it; ``ends`` has the chains that end here."""

    chains: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    after: list[tuple[FilterSpec, _Node]] = field(default_factory=list)

    def add(self, chain: int, steps: tuple[FilterSpec, ...]) -> None:
        self.chains.append(chain)
        if not steps:
            self.ends.append(chain)
            return
        for step, node in self.after:
            if step == steps[0]:
                return node.add(chain, steps[1:])
        self.after.append((steps[0], _Node()))
        return self.after[-1][1].add(chain, steps[1:])


class _Merged:
    """The columns held so far, and which of them each chain ends with."""

    def __init__(self, df: DataFrame, chains: int, tables: dict[str, DataFrame] | None):
        self.chains, self.tables, self.count = chains, tables, 0
        names = [c for c in df.columns if c != CHAIN]
        self.base = {n: self._new() for n in names}
        self.df = df.select(CHAIN, *[tx.field(n).alias(h) for n, h in self.base.items()])
        self.ended: dict[int, dict[str, str]] = {}

    def _new(self) -> str:
        self.count += 1
        return f"{HELD}{self.count}"

    def _among(self, chains: list[int]) -> Column:
        return F.lit(True) if len(chains) == self.chains else F.col(CHAIN).isin(chains)

    def walk(self, node: _Node, names: dict[str, str]) -> None:
        for chain in node.ends:
            self.ended[chain] = names
        for step, following in node.after:
            steps = [step]
            while not following.ends and len(following.after) == 1:
                step, following = following.after[0]
                steps.append(step)
            self.walk(following, self._run(steps, self._among(following.chains), names))

    def _run(self, steps: list[FilterSpec], mine: Column, names: dict[str, str]) -> dict[str, str]:
        """Run steps for the rows of ``mine``; returns the columns of these rows after them."""
        df = self.df.withColumns({n: F.when(mine, F.col(h)) for n, h in names.items()})
        changed: set[str] = {REST, MISTYPED} if is_open(df) else set()
        for spec in steps:
            df = self._step(df, spec, mine, changed)
        lower, changed = {n.lower(): n for n in names}, {c.lower() for c in changed}
        after, moved, shown = {}, {}, [c for c in df.columns if not c.startswith(HELD)]
        for name in shown:
            if name.lower() in lower and name.lower() not in changed:
                after[name] = names[lower[name.lower()]]
            else:
                after[name] = self._new()
                moved[after[name]] = tx.field(name)
        self.df = (df.withColumns(moved) if moved else df).drop(*shown)
        return after

    def _step(self, view: DataFrame, spec: FilterSpec, mine: Column, changed: set[str]) -> DataFrame:
        view, extra = with_members(view, in_condition(spec.condition or ""), as_text=True, keep=True)
        effect = build_effect(view, spec, self.tables, {})
        guards = [F.expr(spec.condition)] if spec.condition else []
        guards += [F.col("_error").isNull()] if tx.has(view, "_error") else []
        for i, guard in enumerate(guards):
            guards[0] = guards[0] & guard if i else guard
        whole, guard = effect.whole is not None, guards[0] if guards else None
        if whole:
            changed.update(c for c in view.columns if not c.startswith(HELD))
        changed.update(effect.sets, effect.drops)
        if whole and effect.local:
            return (_edited(effect, guard) if guards else effect.run()).drop(*extra)
        if whole:
            effect = guarded(effect, mine & guard if guards else mine)
        elif guards:
            effect = guarded(effect, guard)
        if effect.keep is not None:
            effect = replace(effect, keep=~mine | tx.is_true(effect.keep))
        if effect.explode is not None:
            target, items = effect.explode
            changed.add(target)
            element = effect.df.select(items.alias("v")).schema["v"].dataType
            effect = replace(effect, explode=(target, F.when(mine, items).otherwise(F.array(F.lit(None)).cast(element))))
        return effect.run().drop(*extra)

    def result(self) -> DataFrame:
        """Each row with the columns of its chain, NULL in those that only other chains have."""
        found: dict[str, tuple[str, dict[str, list[int]]]] = {}
        for chain in sorted(self.ended):
            for name, held in self.ended[chain].items():
                found.setdefault(name.lower(), (name, {}))[1].setdefault(held, []).append(chain)
        columns = []
        for name, sources in found.values():
            kinds = {h: self.df.schema[h].dataType for h in sources}
            known = {k.simpleString() for k in kinds.values() if not isinstance(k, T.NullType)}
            value = None
            for held, chains in sources.items():
                one = F.col(held) if len(known) < 2 else _variant(F.col(held), kinds[held])
                if len(sources) == 1 and len(chains) == self.chains:
                    value = one
                else:
                    value = (F if value is None else value).when(F.col(CHAIN).isin(chains), one)
            columns.append(value.alias(name))
        return self.df.select(*columns)


def _edited(effect: Effect, guard: Column) -> DataFrame:
    """A column-editing function, with the old values of the chain's columns where the guard is false."""
    before = effect.df
    shown = [c for c in before.columns if not c.startswith(HELD)]
    olds = {name.lower(): f"{HELD}old_{i}" for i, name in enumerate(shown)}
    marked = before.withColumns({GUARD: tx.is_true(guard), **{olds[n.lower()]: tx.field(n) for n in shown}})
    after = effect.whole(marked)
    live, edited = F.col(GUARD), {}
    schema = {f.name.lower(): f.dataType for f in after.schema.fields}
    for name in after.columns:
        if name.startswith(HELD) or name == GUARD:
            continue
        old = F.lit(None)
        if name.lower() in olds:
            kind, was = schema[name.lower()], schema[olds[name.lower()]]
            old = F.col(olds[name.lower()])
            if kind != was:
                old = old.try_cast(kind) if castable(was, kind) else F.lit(None)
        edited[name] = F.when(live, tx.field(name)).otherwise(old)
    edited |= {name: F.when(~live, F.col(olds[name.lower()])) for name in shown if name.lower() not in schema}
    return after.withColumns(edited).drop(GUARD, *olds.values())


def _variant(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_variant_object(value)
    return value if isinstance(kind, T.VariantType) else value.cast(T.VariantType())


def route_once(
    df: DataFrame,
    specs: dict[tuple[str, str], Any],
    tables: dict[str, DataFrame] | None = None,
    fallback: Any = None,
    keys: tuple[str, str] = ("tenant_id", "dataset_id"),
) -> DataFrame:
    """Run every (tenant, dataset) through its own chain like :func:`route`, reading the input once.

    For inputs that are not partitioned by the two keys: :func:`route` would read those once for each distinct chain.  The columns are those of
    all chains; a column to which chains give different types is a VARIANT.  A custom step registered with ``rows`` still reads its input
    twice.
    """
    tenant, dataset = (tx.field(k) for k in keys)
    chains: list[ChainSpec] = []
    members: list[dict[str, list[str]]] = []
    for (t, d), source in specs.items():
        spec = as_spec(source)
        at = next((i for i, c in enumerate(chains) if c.active == spec.active), len(chains))
        if at == len(chains):
            chains.append(spec)
            members.append({})
        members[at].setdefault(t, []).append(d)
    chains.append(default_spec() if fallback is None else as_spec(fallback))
    number = F.lit(len(chains) - 1)
    for i, of in enumerate(members):
        for t, d in of.items():
            number = F.when((tenant == t) & dataset.isin(d), i).otherwise(number)
    root = _Node()
    for i, chain in enumerate(chains):
        root.add(i, chain.active)
    merged = _Merged(once(opened(df), CHAIN, number), len(chains), tables)
    merged.walk(root, merged.base)
    return merged.result()
