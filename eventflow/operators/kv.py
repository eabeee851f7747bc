"""The kv step: key/value pairs out of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json_text as js
from ..functions import text as tx
from .effect import Effect, once, operator, unchanged


def pairs(
    value: Column,
    field_split: str,
    value_split: str,
    include_keys: list[str] | None = None,
    exclude_keys: list[str] | None = None,
    trim_key: str = "",
    trim_value: str = "",
) -> Column:
    """``array<struct<key,value>>`` of a text, in text order, repeated keys included."""

    def pair(piece: Column) -> Column:
        parts = tx.split_literal(piece, value_split, 2)
        return tx.let(
            parts,
            lambda p: F.struct(
                tx.trim_space(tx.trim_chars(F.get(p, F.lit(0)), trim_key)).alias("key"),
                tx.trim_space(tx.trim_chars(F.get(p, F.lit(1)), trim_value)).alias("value"),
            ),
        )

    def wanted(p: Column) -> Column:
        keep = p["value"].isNotNull() & (p["key"] != "")
        if include_keys:
            keep = keep & p["key"].isin(list(include_keys))
        if exclude_keys:
            keep = keep & ~p["key"].isin(list(exclude_keys))
        return keep

    pieces = F.transform(tx.split_literal(value, field_split), tx.trim_space)
    return F.filter(F.transform(pieces, pair), wanted)


def _has_key(key: str):
    return lambda pair: pair["key"] == key


@operator("kv")
def kv(
    df: DataFrame,
    source_field: str = "message",
    field_split: str = " ",
    value_split: str = "=",
    target_field: str | None = None,
    prefix: str = "",
    include_keys: list[str] | None = None,
    exclude_keys: list[str] | None = None,
    trim_key: str = "",
    trim_value: str = "",
    allow_duplicate: bool = True,
    default_values: dict[str, str] | None = None,
    remove_field: bool = False,
    fields: list[str] | None = None,
) -> Effect:
    """Parse ``k=v`` pairs into columns or a map.

    Columns need names that are known up front: ``fields``, or else ``include_keys`` and the keys
    of ``default_values``.  Without these, or with ``target_field``, all pairs go into one
    ``map<string,string>`` column (``kv`` by default).
    """
    if not tx.is_string(df, source_field) or not field_split or not value_split:
        return unchanged(df)
    defaults = default_values or {}
    found = pairs(
        tx.field(source_field), field_split, value_split, include_keys, exclude_keys, trim_key, trim_value
    )
    prepared = once(df, "_pairs", found)
    listed = tx.field("_pairs")
    any_found = F.coalesce(F.size(listed) > 0, F.lit(False))
    declared = list(dict.fromkeys([*(fields or include_keys or []), *(defaults if fields or include_keys else [])]))
    sets: dict[str, Column] = {}
    if target_field or not declared:
        target = target_field or "kv"
        mapped = js.last_wins_map(listed, "key", first=not allow_duplicate)
        if defaults:
            standard = F.create_map(*[F.lit(x) for item in defaults.items() for x in item])
            mapped = tx.let(
                mapped,
                lambda m: F.map_concat(m, F.map_filter(standard, lambda k, _: ~F.map_contains_key(m, k))),
            )
        value = F.when(any_found, mapped)
        if tx.has(df, target) and tx.type_of(df, target).simpleString() == "map<string,string>":
            value = F.coalesce(value, tx.field(target))
        sets[target] = value
    else:
        for key in declared:
            hits = F.filter(listed, _has_key(key))
            value = F.try_element_at(hits, F.lit(-1 if allow_duplicate else 1))["value"]
            if key in defaults:
                value = F.coalesce(value, F.when(any_found, F.lit(defaults[key])))
            name = prefix + key
            sets[name] = F.coalesce(value, tx.field_text(df, name)) if tx.has(df, name) else value
    if remove_field:
        sets[source_field] = F.when(~any_found, tx.field(source_field))
    return Effect(prepared, sets=sets, applied=any_found, temps=("_pairs",))
