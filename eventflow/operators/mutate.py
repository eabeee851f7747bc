"""The mutate step: thirteen field operations applied in a fixed order."""

from __future__ import annotations


from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text as js
from ..functions import regex as rx
from ..functions import text as tx
from .effect import Effect, operator, require
from .fields import moved

# The boolean spellings that convert, true and false.
TRUE_TEXT = ["1", "t", "T", "TRUE", "true", "True"]
FALSE_TEXT = ["0", "f", "F", "FALSE", "false", "False"]

_FLOAT_TEXT = r"\A[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\z"


def copy(df: DataFrame, source: str, target: str) -> DataFrame:
    """Copy a field where it is present."""
    if not tx.has(df, source) or source == target:
        return df
    return df.withColumn(target, moved(df, source, target))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename fields one after the other, in configuration order."""
    for old, new in mapping.items():
        if tx.has(df, old) and old != new:
            if tx.has(df, new):
                df = df.withColumn(new, moved(df, old, new)).drop(old)
            else:
                df = df.withColumnRenamed(old, new)
    return df


def converted(value: Column, kind: T.DataType, target: str) -> Column:
    """Value converted to string / integer / float / boolean; NULL when it does not convert."""
    number = isinstance(kind, tx.NUMERIC)
    string = isinstance(kind, T.StringType)
    if target == "string":
        return tx.text(value, kind)
    if target in ("integer", "int"):
        if string:
            return F.when(value.rlike(r"\A[+-]?\d+\z"), value.try_cast("bigint"))
        return value.try_cast("bigint") if number else F.lit(None).cast("bigint")
    if target == "float":
        if string:
            return F.when(value.rlike(_FLOAT_TEXT), value.try_cast("double"))
        return value.cast("double") if number else F.lit(None).cast("double")
    if target in ("boolean", "bool"):
        if isinstance(kind, T.BooleanType):
            return value
        if string:
            return F.when(value.isin(TRUE_TEXT), F.lit(True)).when(value.isin(FALSE_TEXT), F.lit(False))
        return value != 0 if number else F.lit(None).cast("boolean")
    raise ValueError(f"unknown target type: {target}")


def convert(df: DataFrame, mapping: dict[str, str], keep_raw: bool = False) -> DataFrame:
    """Convert field types; with ``keep_raw`` the old text stays in ``<field>_raw`` on failure."""
    sets: dict[str, Column] = {}
    for name, target in mapping.items():
        result = converted(tx.field(name), tx.type_of(df, name), target) if tx.has(df, name) else None
        if result is None:
            require(target in ("string", "integer", "int", "float", "boolean", "bool"), f"unknown target type: {target}")
            continue
        sets[name] = result
        if keep_raw:
            sets[name + "_raw"] = F.when(result.isNull(), tx.field_text(df, name))
    return df.withColumns(sets) if sets else df


def split(df: DataFrame, field: str, separator: str, target: str | None = None) -> DataFrame:
    """Split a string into an array; an empty separator turns the operation off."""
    if not separator or not tx.is_string(df, field):
        return df
    parts = tx.split_literal(tx.field(field), separator)
    target = target or field
    if target != field and tx.has(df, target) and isinstance(tx.type_of(df, target), T.ArrayType):
        parts = F.coalesce(parts, tx.field(target))
    return df.withColumn(target, parts)


def join(df: DataFrame, field: str, separator: str, target: str | None = None) -> DataFrame:
    """Join an array into a string."""
    if not separator or not tx.has(df, field) or not isinstance(tx.type_of(df, field), T.ArrayType):
        return df
    element = tx.type_of(df, field).elementType
    texts = F.transform(tx.field(field), lambda x: F.coalesce(tx.text(x, element), F.lit("<nil>")))
    joined = F.array_join(texts, separator)
    target = target or field
    if target != field and tx.has(df, target):
        joined = F.coalesce(joined, tx.field_text(df, target))
    return df.withColumn(target, joined)


def gsub(df: DataFrame, rules: list[dict[str, str]]) -> DataFrame:
    """Regex replacements on string fields, applied in list order."""
    changed: dict[str, Column] = {}
    for rule in rules:
        name, pattern = rule.get("field"), rule.get("pattern")
        if name and pattern:
            rx.compile_pattern(pattern)
            if tx.is_string(df, name):
                changed[name] = rx.replace_all(changed.get(name, tx.field(name)), pattern, rule.get("replacement", ""))
    return df.withColumns(changed) if changed else df


def _each_string(df: DataFrame, names: list[str], change) -> DataFrame:
    sets = {n: change(tx.field(n)) for n in names if tx.is_string(df, n)}
    return df.withColumns(sets) if sets else df


def lowercase(df: DataFrame, fields: list[str]) -> DataFrame:
    return _each_string(df, fields, F.lower)


def uppercase(df: DataFrame, fields: list[str]) -> DataFrame:
    return _each_string(df, fields, F.upper)


def strip(df: DataFrame, fields: list[str]) -> DataFrame:
    """Strip surrounding white space, Unicode kinds included."""
    return _each_string(df, fields, tx.trim_space)


def merged(df: DataFrame, source: str, target: str) -> Column:
    """Target after the source was merged in, by the static types of both."""
    s, t = tx.field(source), tx.field(target)
    st, tt = tx.type_of(df, source), tx.type_of(df, target)
    if isinstance(tt, T.ArrayType):
        if isinstance(st, T.ArrayType):
            both = F.concat(t, s) if st.elementType == tt.elementType else F.concat(
                F.transform(t, lambda x: tx.text(x, tt.elementType)),
                F.transform(s, lambda x: tx.text(x, st.elementType)),
            )
            alone = (t, s) if st.elementType == tt.elementType else (
                F.transform(t, lambda x: tx.text(x, tt.elementType)),
                F.transform(s, lambda x: tx.text(x, st.elementType)),
            )
        elif st == tt.elementType:
            both, alone = F.array_append(t, s), (t, F.array(s))
        else:
            texts = F.transform(t, lambda x: tx.text(x, tt.elementType))
            both, alone = F.array_append(texts, tx.text(s, st)), (texts, F.array(tx.text(s, st)))
    elif isinstance(tt, T.MapType) and isinstance(st, T.MapType):
        both, alone = js.last_wins_map(F.concat(F.map_entries(t), F.map_entries(s)), "key"), (t, s)
    elif isinstance(tt, T.StructType) and isinstance(st, T.StructType):
        names = tt.names + [n for n in st.names if n not in tt.names]

        def member(name: str) -> Column:
            sides = [x.getField(name) for x, k in ((s, st), (t, tt)) if name in k.names]
            return F.coalesce(*sides).alias(name)

        present = s.isNotNull() | t.isNotNull()
        return F.when(present, F.struct(*[member(n) for n in names]))
    elif isinstance(tt, T.StringType) and isinstance(st, T.StringType):
        both, alone = F.concat(t, s), (t, s)
    else:
        return F.coalesce(s, t) if st == tt else F.coalesce(tx.text(s, st), tx.text(t, tt))
    return F.when(s.isNull(), alone[0]).when(t.isNull(), alone[1]).otherwise(both)


def merge(df: DataFrame, rules: list[dict[str, str]]) -> DataFrame:
    """Merge a source field into a target: arrays and strings concatenate, objects combine."""
    for rule in rules:
        source, target = rule.get("source"), rule.get("target")
        if source and target and tx.has(df, source):
            df = df.withColumn(target, merged(df, source, target) if tx.has(df, target) else tx.field(source))
    return df


def literal(value: Any) -> Column:
    """Configuration value as a column."""
    if isinstance(value, dict):
        return F.struct(*[literal(v).alias(k) for k, v in value.items()])
    if isinstance(value, list):
        return F.array(*[literal(v) for v in value])
    return F.lit(value)


def update(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Set fields where they are present."""
    sets = {n: F.when(tx.field(n).isNotNull(), literal(v)) for n, v in values.items() if tx.has(df, n)}
    return df.withColumns(sets) if sets else df


def replace(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Set fields always."""
    return df.withColumns({n: literal(v) for n, v in values.items()}) if values else df


def add(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Set fields where they are missing."""
    sets = {}
    for name, value in values.items():
        if not tx.has(df, name):
            sets[name] = literal(value)
        elif isinstance(tx.type_of(df, name), T.StringType):
            sets[name] = F.coalesce(tx.field(name), F.lit(tx.config_text(value)))
        else:
            sets[name] = F.coalesce(tx.field(name), literal(value).try_cast(tx.type_of(df, name)))
    return df.withColumns(sets) if sets else df


def remove(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.drop(*[f for f in fields if tx.has(df, f)])


def _touched(df: DataFrame, config: dict[str, Any]) -> Column:
    """Whether any of the operations finds its field in the row."""
    if config.get("replace") or config.get("add"):
        return F.lit(True)
    names = [*config.get("copy", {}), *config.get("rename", {}), *config.get("convert", {}), *config.get("update", {})]
    for key in ("lowercase", "uppercase", "strip", "remove"):
        names += config.get(key, [])
    names += [config.get(key, {}).get("field") for key in ("split", "join")]
    names += [rule.get("source") for rule in config.get("merge", [])]
    names += [rule.get("field") for rule in config.get("gsub", [])]
    return tx.any_of([tx.field(n).isNotNull() for n in dict.fromkeys(names) if n and tx.has(df, n)])


def steps(config: dict[str, Any]):
    """The configured operations in their fixed order, as DataFrame functions."""
    for source, target in config.get("copy", {}).items():
        yield lambda d, s=source, t=target: copy(d, s, t)
    if config.get("rename"):
        yield lambda d: rename(d, config["rename"])
    if config.get("convert"):
        yield lambda d: convert(d, config["convert"], bool(config.get("keep_raw")))
    for key, change in (("split", split), ("join", join)):
        rule = config.get(key) or {}
        if rule.get("field"):
            yield lambda d, r=rule, c=change: c(d, r["field"], r.get("separator", ""), r.get("target"))
    if config.get("gsub"):
        yield lambda d: gsub(d, config["gsub"])
    for key, change in (("lowercase", lowercase), ("uppercase", uppercase), ("strip", strip), ("merge", merge)):
        if config.get(key):
            yield lambda d, k=key, c=change: c(d, config[k])
    for key, change in (("update", update), ("replace", replace), ("add", add), ("remove", remove)):
        if config.get(key):
            yield lambda d, k=key, c=change: c(d, config[k])


@operator("mutate")
def mutate(df: DataFrame, **config) -> Effect:
    """copy, rename, convert, split, join, gsub, lowercase, uppercase, strip, merge, update, replace, remove."""
    rules = list(steps(config))

    def run(d: DataFrame) -> DataFrame:
        for rule in rules:
            d = rule(d)
        return d

    run(df)  # a bad pattern or target type fails when the chain is built
    return Effect(df, whole=run, local=True, applied=_touched(df, config))
