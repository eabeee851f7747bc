"""Field edits: add, remove, rename, regex replace, key case, flatten, fingerprint, passthrough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text as js
from ..functions import regex as rx
from ..functions import text as tx
from .effect import Effect, once, operator, require, unchanged
from .records import MISTYPED, REST, upper_json_keys


def template_variables(
    df: DataFrame,
    tenant_id: str | None = None,
    dataset_id: str | None = None,
    line_number: str | None = None,
    variables: dict[str, str] | None = None,
) -> dict[str, Column]:
    """Values of the ``${...}`` placeholders; tenant and dataset default to their columns."""

    def context(value: str | None, column: str) -> Column:
        if value is not None:
            return F.lit(value)
        return F.coalesce(tx.field_text(df, column), F.lit("")) if tx.has(df, column) else F.lit("")

    line = tx.field_text(df, line_number) if line_number else F.lit("0")
    known = {
        "timestamp": tx.rfc3339_now(),
        "tenant_id": context(tenant_id, "tenant_id"),
        "dataset_id": context(dataset_id, "dataset_id"),
        "line_number": line,
    }
    return {**known, **{name: F.lit(value) for name, value in (variables or {}).items()}}


@operator("add_field")
def add_field(df: DataFrame, field: str, value: str, **context) -> Effect:
    """Set a string field; ``${timestamp}``, ``${tenant_id}``, ``${dataset_id}``, ``${line_number}``
    and user variables are filled in."""
    require(bool(field), "add_field needs 'field'")
    require(isinstance(value, str), "add_field needs a string 'value'")
    return Effect(df, sets={field: tx.interpolate(value, template_variables(df, **context))})


@operator("remove_field")
def remove_field(df: DataFrame, field: str | None = None, fields: list[str] | None = None) -> Effect:
    """Drop fields; missing ones are ignored."""
    names = ([field] if field else []) + list(fields or [])
    require(bool(names), "remove_field needs 'field' or 'fields'")
    return Effect(df, drops=tuple(names))


def moved(df: DataFrame, source: str, target: str) -> Column:
    """Value of ``target`` after ``source`` was copied over it where present."""
    if not tx.has(df, target):
        return tx.field(source)
    old, new = tx.type_of(df, target), tx.type_of(df, source)
    if old == new:
        return F.coalesce(tx.field(source), tx.field(target))
    return F.coalesce(tx.field_text(df, source), tx.field_text(df, target))


@operator("rename_field")
def rename_field(df: DataFrame, **config) -> Effect:
    """Rename ``from`` to ``to``, overwriting it; rows without ``from`` keep their ``to``."""
    source, target = config.get("from"), config.get("to")
    require(bool(source), "rename_field needs 'from'")
    require(bool(target), "rename_field needs 'to'")
    if not tx.has(df, source) or source == target:
        return Effect(df)
    return Effect(df, sets={target: moved(df, source, target)}, drops=(source,))


@operator("regex_replace")
def regex_replace(
    df: DataFrame,
    pattern: str,
    replacement: str = "",
    source_field: str = "message",
    target_field: str | None = None,
    **config,
) -> Effect:
    """Replace all matches (templates allowed) or, with ``global=false``, the first one literally."""
    require(bool(pattern), "regex_replace needs 'pattern'")
    everywhere = config.get("global", True)
    source_field = source_field or "message"
    target = target_field or source_field
    rx.compile_pattern(pattern)
    if not tx.has(df, source_field):
        return unchanged(df)
    value = tx.field_text(df, source_field)
    change = rx.replace_all if everywhere else rx.replace_first
    result = change(value, pattern, replacement or "")
    if target != source_field and tx.has(df, target):
        result = F.coalesce(result, tx.field_text(df, target))
    return Effect(df, sets={target: result}, applied=value.isNotNull())


def _upper_type(kind: T.DataType, recursive: bool, inside_array: bool = False) -> T.DataType:
    """Same type with upper-case field names; arrays in arrays are left alone."""
    if isinstance(kind, T.StructType):
        return T.StructType(
            [
                T.StructField(f.name.upper(), _upper_type(f.dataType, recursive) if recursive else f.dataType, f.nullable)
                for f in kind.fields
            ]
        )
    if isinstance(kind, T.ArrayType) and not inside_array and isinstance(kind.elementType, T.StructType):
        return T.ArrayType(_upper_type(kind.elementType, recursive, True), kind.containsNull)
    return kind


def _upper_keys(value: Column, kind: T.DataType, recursive: bool) -> Column:
    if isinstance(kind, T.StructType):
        return value.cast(_upper_type(kind, recursive))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return value.cast(_upper_type(kind, recursive))
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                F.upper(e["key"]).alias("key"),
                (_upper_keys(e["value"], kind.valueType, recursive) if recursive else e["value"]).alias("value"),
            ),
        )
        return js.last_wins_map(entries, "key")
    if isinstance(kind, T.VariantType) and recursive:
        return F.try_parse_json(upper_json_keys(F.to_json(value)))
    if isinstance(kind, T.VariantType):
        members = F.map_entries(js.as_object(value))
        upper = js.last_wins_map(F.transform(members, lambda e: F.struct(F.upper(e["key"]).alias("key"), e["value"].alias("value"))), "key")
        return F.when(js.as_object(value).isNull(), value).otherwise(F.to_variant_object(upper))
    return value


@operator("uppercase_keys")
def uppercase_keys(df: DataFrame, source_field=None, recursive: bool = True) -> Effect:
    """Upper-case the field names of the record, or of the listed object fields."""
    names = source_field if isinstance(source_field, list) else [source_field]
    names = [n for n in names if n and n != "*"]
    if names:
        nested = [n for n in names if tx.has(df, n) and isinstance(tx.type_of(df, n), (T.StructType, T.MapType, T.VariantType))]
        return Effect(
            df,
            sets={n: _upper_keys(tx.field(n), tx.type_of(df, n), recursive) for n in nested},
            applied=tx.any_of([tx.field(n).isNotNull() for n in nested]),
        )
    sets: dict[str, Column] = {}
    for f in df.schema.fields:
        if not f.name.startswith("_"):
            sets[f.name.upper()] = _upper_keys(tx.field(f.name), f.dataType, recursive) if recursive else tx.field(f.name)
    # the names of undeclared members, and the marks of declared ones
    for name in (REST, MISTYPED):
        if tx.has(df, name):
            sets[name] = _upper_keys(tx.field(name), tx.type_of(df, name), recursive)
    sets = {**sets, **{c: tx.field(c) for c in df.columns if c.startswith("_") and c not in sets}}
    own = set(df.columns)

    # Spark resolves names without regard to case, so the record is rebuilt by a projection.
    def rebuild(d: DataFrame) -> DataFrame:
        others = [tx.field(n) for n in d.columns if n not in own]
        return d.select(*[v.alias(n) for n, v in sets.items()], *others)

    return Effect(df, whole=rebuild, local=True)


def _leaves(value: Column, kind: T.DataType, name: str, separator: str, lengths: dict[str, int], open_: list):
    """(path, column) of every leaf below a typed column.

    Arrays, maps and variants have as many leaves as the data gives them; (path, first index, value) of these, and of the
    elements past a declared length, go to ``open_``.
    """
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _leaves(value.getField(f.name), f.dataType, name + separator + f.name, separator, lengths, open_)
    elif isinstance(kind, T.ArrayType) and name in lengths:
        for i in range(lengths[name]):
            item, path = F.get(value, F.lit(i)), f"{name}{separator}{i}"
            yield from _leaves(item, kind.elementType, path, separator, lengths, open_)
        open_.append((name, lengths[name], F.slice(value, lengths[name] + 1, F.greatest(F.lit(0), F.size(value) - lengths[name]))))
    elif isinstance(kind, (T.ArrayType, T.VariantType)) or isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        open_.append((name, None, value if isinstance(kind, T.VariantType) else F.to_variant_object(value)))
    else:
        yield name, value


def _open_leaves(open_: list, rest: Column | None, separator: str) -> Column:
    """``map<string,variant>`` of all leaves of values whose shape only the data tells."""
    parts = []
    for name, first, value in open_:
        if first is None:
            entries = F.array(F.struct(F.lit(name).alias("key"), value.alias("value")))
        else:
            entries = F.transform(value, _numbered(name + separator, first))
        parts.append(F.coalesce(entries, F.array().cast("array<struct<key:string,value:variant>>")))
    if rest is not None:
        parts.append(F.coalesce(F.map_entries(rest), F.array().cast("array<struct<key:string,value:variant>>")))
    root = F.filter(F.concat(*parts), lambda e: e["value"].isNotNull())
    members = js.last_wins_map(root, "key")
    return tx.let(members, lambda m: js.flatten_object(m, js.nesting_depth(F.to_json(m)), separator))


def _numbered(path: str, first: int):
    def entry(x: Column, i: Column) -> Column:
        return F.struct(F.concat(F.lit(path), (i + first).cast("string")).alias("key"), _variant(x).alias("value"))

    return entry


def _variant(value: Column) -> Column:
    """Variant of a value of any type."""
    return F.try_variant_get(F.to_variant_object(F.array(value)), "$[0]", "variant")


@operator("json_flatten")
def json_flatten(
    df: DataFrame,
    source_field: str | None = None,
    target_field: str = "@flatten",
    separator: str = ".",
    array_lengths: dict[str, int] | None = None,
) -> Effect:
    """Flatten the whole record, or one object / JSON text field into a map.

    Whole record: struct columns become one column per leaf.  Columns need names known beforehand, so
    the leaves of arrays, maps and variants become members of ``_rest`` (written as fields like the others),
    however many there are.  ``array_lengths`` spreads the first elements of an array to columns.  With ``source_field``
    the result is a ``map<string,variant>`` of all leaves, whatever the data holds.
    """
    separator = separator or "."
    if not source_field:
        lengths, open_ = array_lengths or {}, []
        sets: dict[str, Column] = {}
        drops: list[str] = []
        for f in df.schema.fields:
            if not f.name.startswith("_") and isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
                sets.update(_leaves(tx.field(f.name), f.dataType, f.name, separator, lengths, open_))
                drops.append(f.name)
        rest = tx.field(REST) if tx.has(df, REST) else None
        if open_ or rest is not None:
            sets[REST] = _open_leaves(open_, rest, separator)
        return Effect(df, sets=sets, drops=tuple(drops))
    if not tx.has(df, source_field):
        return unchanged(df)
    value, kind = tx.field(source_field), tx.type_of(df, source_field)
    target = target_field or "@flatten"
    if isinstance(kind, T.StringType):
        text = value
    elif isinstance(kind, T.VariantType):
        text = value.cast("string")
    elif isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
        text = F.to_json(value)
    else:
        text = tx.text(value, kind)
    prepared = once(df, "_doc", js.wrapped_json(text))
    valid = js.is_complete(F.col("_doc"))
    members = F.when(valid, F.try_variant_get("_doc", "$[0]", "map<string,variant>"))
    prepared = once(prepared, "_root", F.struct(valid.alias("valid"), members.alias("members")))
    root = F.col("_root.members")
    # An object without inner objects and arrays is its own result.
    flat = (js.brace_count(text) <= 1) & ~text.contains("[")
    leaves = (
        F.when(~F.col("_root.valid"), F.lit(None))
        .when(root.isNull(), F.create_map(F.lit("value"), F.try_variant_get("_doc", "$[0]", "variant")))
        .when(flat, root)
        .otherwise(js.flatten_object(root, js.nesting_depth(text), separator))
    )
    prepared = once(prepared, "_leaves", leaves)
    result = tx.field("_leaves")
    if tx.has(df, target) and tx.type_of(df, target) == T.MapType(T.StringType(), T.VariantType()):
        result = F.coalesce(result, tx.field(target))
    return Effect(
        prepared, sets={target: result}, applied=F.col("_root.valid"), temps=("_doc", "_root", "_leaves")
    )


@operator("fingerprint")
def fingerprint(
    df: DataFrame,
    source_fields: list[str],
    target_field: str = "fingerprint",
    method: str = "SHA256",
    key_separator: str = "|",
    base64encode: bool = False,
    include_keys: bool = False,
) -> Effect:
    """Hash of the present source fields; the field is not set when none is present."""
    hashes = {
        "MD5": F.md5,
        "SHA1": F.sha1,
        "SHA256": lambda c: F.sha2(c, 256),
        "SHA512": lambda c: F.sha2(c, 512),
    }
    require(method.upper() in hashes, f"invalid hash method {method!r}")
    names = [n for n in source_fields if tx.has(df, n)]
    if not names:
        return unchanged(df)
    parts = [tx.field_text(df, n) for n in names]
    present = tx.any_of([p.isNotNull() for p in parts])
    if include_keys:
        parts = [F.concat(F.lit(n + "="), p) for n, p in zip(names, parts)]
    digest = hashes[method.upper()](F.concat_ws(key_separator, *parts).cast("binary"))
    if base64encode:
        # The base64 form is of the hexadecimal text; line breaks are taken out again.
        digest = F.regexp_replace(F.base64(digest.cast("binary")), r"[\r\n]", "")
    result = F.when(present, digest)
    if tx.has(df, target_field):
        result = F.coalesce(result, tx.field_text(df, target_field))
    return Effect(df, sets={target_field: result}, applied=present)


@operator("passthrough")
def passthrough(df: DataFrame, description: str | None = None) -> Effect:
    """Leave every row as it is."""
    return Effect(df)
