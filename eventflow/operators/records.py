"""Records whose fields are not all declared: members of a VARIANT object or map beside the columns.

``_rest`` (map<string,variant>) holds members without a column, ``_mistyped`` (same type) the original values of columns
that are NULL because the value had another type.  A step that names a member gets it as a column first.
"""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text as js
from ..functions import text as tx

REST, MISTYPED, RECORD = "_rest", "_mistyped", "record"

# Steps that only look at their fields, and those that hand values on as they are; all others read text.
LOOKING = frozenset("include exclude drop conditional sample json_validate passthrough".split())
MOVING = frozenset("rename_field remove_field add_field".split())
MUTATE_MOVING = ("rename", "copy", "remove", "merge", "add")
# Options whose texts are no field names.
VALUES = frozenset(
    """pattern patterns value values equals not_equals contains matches any_equals any_matches unless_equals unless_matches
    replacement separator delimiter field_split value_split prefix operator action method match custom_patterns formats format timezone
    locale description tables table enricher_id enrichment settings parser parser_name seed tag tag_on_failure key_separator output_format
    target_timezone emit include_keys_pattern""".split()
)
_NAME = re.compile(r"[\w@][\w@.\- ]{0,99}")
_WORDS = frozenset("and or not is null in like rlike between case when then else end true false div cast as string int bigint double boolean date timestamp".split())


def is_open(df: DataFrame) -> bool:
    """Whether records can have members without a column."""
    return REST in df.columns or RECORD in df.columns and isinstance(df.schema[RECORD].dataType, T.VariantType)


def opened(df: DataFrame) -> DataFrame:
    """The same with the undeclared members in ``_rest``; a VARIANT ``record`` is split from the columns it has."""
    if REST in df.columns or not is_open(df):
        return df
    declared = [c for c in df.columns if not c.startswith("_") and c != RECORD]
    members = js.as_object(F.col(RECORD))
    if declared:
        members = F.map_filter(members, lambda k, _: ~k.isin(declared))
    return df.withColumn(REST, members).drop(RECORD)


def named(config: Any, key: str = "") -> set[str]:
    """Texts in a step's configuration that can be field names."""
    if isinstance(config, str):
        return {config} if _NAME.fullmatch(config) else set()
    if isinstance(config, dict):
        names = set().union(*[named(v, k) for k, v in config.items() if k not in VALUES])
        # mappings such as {old: new} name fields by their keys
        return names | ({k for k in config if isinstance(k, str) and _NAME.fullmatch(k)} if key else set())
    if isinstance(config, (list, tuple)):
        return set().union(*[named(v, key) for v in config])
    return set()


def in_condition(condition: str) -> set[str]:
    """Identifiers of a SQL condition."""
    plain = re.sub(r"'(?:[^'\\]|\\.|'')*'", " ", condition)
    names = {m[1] or m[2] for m in re.finditer(r"`([^`]+)`|\b([A-Za-z_]\w*)\b(?!\s*\()", plain)}
    return {n for n in names if n.lower() not in _WORDS}


def with_members(df: DataFrame, names: set[str], as_text: bool, keep: bool) -> tuple[DataFrame, tuple[str, ...]]:
    """Columns for the named members; ``keep`` leaves them in ``_rest`` too, for columns that go again after the step."""
    if not is_open(df):
        return df, ()
    df = opened(df)
    lower = {c.lower() for c in df.columns}
    heads = {n for n in names if n.lower() not in lower} | {n.split(".")[0] for n in names if n.split(".")[0].lower() not in lower}
    heads = sorted(h for h in heads if not h.startswith("_"))
    if not heads:
        return df, ()
    dotted = {n.split(".")[0] for n in names if "." in n}
    member = lambda n: F.try_element_at(tx.field(REST), F.lit(n))
    made = {n: member(n).cast("string") if as_text and n not in dotted else member(n) for n in heads}
    df = df.withColumns(made)
    if not keep:
        df = df.withColumn(REST, F.map_filter(tx.field(REST), lambda k, _: ~k.isin(heads)))
    return df, tuple(heads)


def resolved(df: DataFrame, step: str, config: dict[str, Any]) -> tuple[DataFrame, tuple[str, ...]]:
    """``df`` with the members that a step names, and the columns to drop after it."""
    if not is_open(df):
        return df, ()
    looking = step in LOOKING
    compared = any(k in config for k in ("equals", "any_equals", "not_equals", "unless_equals"))
    text = any(config.get(k) is not None for k in ("matches", "contains", "any_matches", "unless_matches"))
    as_text = text if looking and compared else step not in MOVING
    if step == "mutate":
        texts = named({k: v for k, v in config.items() if k not in MUTATE_MOVING})
        df, _ = with_members(df, named(config) - texts, as_text=False, keep=False)
    df, names = with_members(df, named(config), as_text, keep=looking)
    return df, names if looking else ()


def record_json(df: DataFrame, columns: list[str]) -> Column:
    """JSON object of the given columns and of what ``_rest``, ``_mistyped`` or a VARIANT ``record`` hold beside them.

    NULL columns are left out.  A column hides a member of the same name.
    """
    declared = [c for c in columns if not (c == RECORD and isinstance(df.schema[c].dataType, T.VariantType))]
    line = F.to_json(F.struct(*[tx.field(c) for c in declared])) if declared else F.lit("{}")
    others: list[Column] = []
    if REST in df.columns:
        others.append(tx.field(REST))
    elif RECORD in columns and len(declared) < len(columns):
        members = js.as_object(F.col(RECORD))
        others.append(F.map_filter(members, lambda k, _: ~k.isin(declared)) if declared else members)
    if MISTYPED in df.columns and declared:
        missing = F.array_compact(F.array(*[F.when(tx.field(c).isNull(), F.lit(c)) for c in declared]))
        kept = F.map_filter(tx.field(MISTYPED), lambda k, _: F.array_contains(missing, k))
        others.append(F.when(F.size(tx.field(MISTYPED)) > 0, kept))
    for other in others:
        line = joined_objects(line, F.coalesce(F.to_json(other), F.lit("{}")))
    return line


def joined_objects(a: Column, b: Column) -> Column:
    """One JSON object text of two."""
    both = F.concat(F.substr(a, F.lit(1), F.length(a) - 1), F.lit(","), F.substr(b, F.lit(2)))
    return F.when(b == "{}", a).when(a == "{}", b).otherwise(both)


def upper_json_keys(text: Column) -> Column:
    """JSON text with the names of all members in upper case; names with an escape stay as they are."""
    parts = F.regexp_extract_all(text, F.lit(r'("(?:[^"\\]|\\.)*":?|[^"]+)'), F.lit(1))
    up = F.transform(parts, lambda p: F.when(p.endswith('":') & ~p.contains("\\"), F.upper(p)).otherwise(p))
    return F.array_join(up, "")


def member_path(name: str) -> str:
    return f"$[{json.dumps(name)}]"
