"""The grok step: named fields from unstructured text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import regex as rx
from ..functions import text as tx
from .effect import Effect, once, operator, require, unchanged
from .grok_patterns import expand


@operator("grok")
def grok(
    df: DataFrame,
    pattern: str | None = None,
    patterns: list[str] | None = None,
    source_field: str = "message",
    custom_patterns: dict[str, str] | None = None,
    break_on_match: bool = True,
    keep_empty_captures: bool = False,
    overwrite_keys: bool = True,
    target_field: str | None = None,
    named_captures_only: bool = True,
) -> Effect:
    """Extract the fields of the first matching pattern (or of all, later ones overwriting)."""
    sources = list(patterns) if patterns else [pattern] if pattern else []
    require(bool(sources), "grok needs 'pattern' or 'patterns'")
    compiled = [rx.compile_pattern(expand(p, custom_patterns)) for p in sources]
    if not tx.is_string(df, source_field):
        return unchanged(df)

    # One helper column per pattern: the captured groups, computed by a single regex pass.
    temps = {
        f"_grok_{i}": rx.captures(tx.field(source_field), p, [index for index, _ in p.names])
        for i, p in enumerate(compiled)
    }
    prepared = df
    for name, value in temps.items():
        prepared = once(prepared, name, value)
    found = [tx.field(name) for name in temps]
    matched = tx.any_of([f.isNotNull() for f in found])

    def capture(position: int, name: str) -> Column | None:
        names = [n for _, n in compiled[position].names]
        if name not in names:
            return None
        value = F.get(found[position], F.lit(names.index(name)))
        return value if keep_empty_captures else F.nullif(value, F.lit(""))

    def result(name: str) -> Column:
        columns = [capture(i, name) for i in range(len(compiled))]
        if not break_on_match:
            return F.coalesce(*[c for c in reversed(columns) if c is not None])
        chain = None
        for i, column in enumerate(columns):
            value = F.lit(None).cast("string") if column is None else column
            chain = (F if chain is None else chain).when(found[i].isNotNull(), value)
        return chain

    fields = list(dict.fromkeys(name for p in compiled for _, name in p.names))
    extracted = {name: result(name) for name in fields}

    if target_field:
        members = dict(extracted)
        old = tx.type_of(df, target_field) if tx.has(df, target_field) else None
        if isinstance(old, T.StructType):
            for name in dict.fromkeys([*old.names, *fields]):
                before = tx.text(tx.field(target_field).getField(name), old[name].dataType) if name in old.names else None
                new = extracted.get(name)
                if new is None:
                    members[name] = before if not overwrite_keys else F.when(~matched, before)
                elif before is not None:
                    members[name] = F.when(matched, new).otherwise(before) if overwrite_keys else F.coalesce(before, new)
        present = matched if old is None else matched | tx.field(target_field).isNotNull()
        value = F.when(present, F.struct(*[v.alias(n) for n, v in members.items()]))
        return Effect(prepared, sets={target_field: value}, applied=matched, temps=tuple(temps))

    sets = {}
    for name, value in extracted.items():
        if tx.has(df, name):
            before = tx.field_text(df, name)
            value = F.coalesce(value, before) if overwrite_keys else F.coalesce(before, value)
        sets[name] = value
    return Effect(prepared, sets=sets, applied=matched, temps=tuple(temps))
