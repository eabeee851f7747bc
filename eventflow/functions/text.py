"""Value rules: field references, text form, equality, trimming and literal splitting.

In typed mode a field is *missing* when its column is absent or NULL.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Unicode counts as white space.
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def field(name: str) -> Column:
    """Top-level column by its literal name; dots and ``@`` are part of the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_string(df: DataFrame, name: str) -> bool:
    return has(df, name) and isinstance(type_of(df, name), (T.StringType, T.VarcharType, T.CharType))


def nested(df: DataFrame, path: str) -> Column | None:
    """Column for a dotted path: a column of that very name, a struct path, map key or variant path."""
    if has(df, path):
        return field(path)
    head, *rest = path.split(".")
    if not has(df, head):
        return None
    current, kind = field(head), type_of(df, head)
    for position, step in enumerate(rest):
        if isinstance(kind, T.StructType):
            if step not in kind.names:
                return None
            current, kind = current.getField(step), kind[step].dataType
        elif isinstance(kind, T.MapType):
            current, kind = F.try_element_at(current, F.lit(step)), kind.valueType
        elif isinstance(kind, T.VariantType):
            keys = "".join("[" + json.dumps(k) + "]" for k in rest[position:])
            return F.try_variant_get(current, "$" + keys, "string")
        else:
            return None
    return current


def text(value: Column, kind: T.DataType) -> Column:
    """Text form of a value: integers plain, whole floats without a fraction, objects as JSON."""
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return value
    if isinstance(kind, FLOATING):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
    return value.cast("string")


def field_text(df: DataFrame, name: str) -> Column:
    return text(field(name), type_of(df, name))


def config_text(value: Any) -> str:
    """Text form of a configuration value, by the same rules as :func:`text`."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float) and value == int(value) and abs(value) < 1e15:
        return str(int(value))
    if isinstance(value, (list, dict)):
        return json.dumps(value, separators=(",", ":"))
    return str(value)


def is_number(value: Any) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def equals(df: DataFrame, name: str, value: Any) -> Column:
    """Same value or same text form; NULL when the field is missing."""
    kind = type_of(df, name)
    if isinstance(kind, NUMERIC) and is_number(value):
        return field(name) == F.lit(value)
    wanted = config_text(value)
    if isinstance(kind, INTEGRAL):
        # The text of an integer is unique, so a comparison of numbers does and the scan can use it.
        canonical = re.fullmatch(r"0|-?[1-9]\d{0,17}", wanted)
        return field(name) == F.lit(int(wanted)) if canonical else F.when(field(name).isNotNull(), F.lit(False))
    return text(field(name), kind) == F.lit(wanted)


def trim_space(value: Column) -> Column:
    """Strip all leading and trailing Unicode white space (linear, no regex)."""
    return F.btrim(value, F.lit(UNICODE_SPACE))


def trim_chars(value: Column, cutset: str) -> Column:
    return F.btrim(value, F.lit(cutset)) if cutset else value


def quote_regex(literal: str) -> str:
    """Regular expression matching exactly this text."""
    return "".join(ch if ch.isalnum() or ch == "_" or ord(ch) > 127 else "\\" + ch for ch in literal)


def split_literal(value: Column, separator: str, limit: int = -1) -> Column:
    return F.split(value, quote_regex(separator), limit)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it in ``body`` several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rfc3339_now() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def interpolate(template: str, variables: dict[str, Column]) -> Column:
    """``${name}`` placeholders replaced by columns; unknown placeholders stay as text."""
    parts: list[Column] = []
    rest = template
    while rest:
        start = rest.find("${")
        end = rest.find("}", start)
        if start < 0 or end < 0:
            parts.append(F.lit(rest))
            break
        name = rest[start + 2 : end]
        if name in variables:
            if start:
                parts.append(F.lit(rest[:start]))
            parts.append(variables[name])
        else:
            parts.append(F.lit(rest[: end + 1]))
        rest = rest[end + 1 :]
    if not parts:
        return F.lit("")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def any_of(conditions: list[Column]) -> Column:
    """OR of several conditions, NULL counting as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions], F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))
