"""Row predicates and sampling: include, exclude, drop, conditional, conditional_field, json_validate, sample.

Every condition is NULL-safe: a missing field never raises and never matches, except for
``ne`` / ``not_contains``, which are true for it.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text as js
from ..functions import regex as rx
from ..functions import text as tx
from .effect import Effect, operator, require
from .mutate import literal

# Seed used when none is configured: a fixed one, so that a retried task decides alike.
DEFAULT_SEED = 42


class Match:
    """OR of conditions on fields, in the two forms a filter needs.

    Both stay plain comparisons joined by AND / OR, so that Catalyst can push them to the scan.
    """

    def __init__(self, conditions: list[tuple[Column, Column]]):
        self.conditions = conditions

    @property
    def found(self) -> Column:
        """True where some condition holds; false or NULL elsewhere."""
        return reduce(lambda a, b: a | b, [c for _, c in self.conditions]) if self.conditions else F.lit(False)

    @property
    def absent(self) -> Column:
        """True where none holds, a missing field included; never NULL where it matters."""
        return tx.all_of([field.isNull() | ~c for field, c in self.conditions])


def matcher(
    df: DataFrame,
    field: str | None = None,
    equals: Any = None,
    contains: str | None = None,
    matches: str | None = None,
    any_field: list[str] | None = None,
    any_equals: Any = None,
    any_matches: str | None = None,
) -> Match:
    """The configured conditions; they do not hold where the fields are missing.

    ``contains`` and ``matches`` look at string fields only.
    """
    for pattern in (matches, any_matches):
        if pattern is not None:
            rx.compile_pattern(pattern)
    found: list[tuple[Column, Column]] = []

    def test(name: str, value: Any, part: str | None, pattern: str | None) -> None:
        if not tx.has(df, name):
            return
        if value is not None:
            found.append((tx.field(name), tx.equals(df, name, value)))
        if part and tx.is_string(df, name):
            found.append((tx.field(name), tx.field(name).contains(part)))
        if pattern is not None and tx.is_string(df, name):
            found.append((tx.field(name), rx.matches(tx.field(name), pattern)))

    if field:
        test(field, equals, contains, matches)
    for name in any_field or []:
        test(name, any_equals, None, any_matches)
    return Match(found)


@operator("include")
def include(df: DataFrame, **config) -> Effect:
    """Keep the rows that match."""
    return Effect(df, keep=matcher(df, **config).found)


@operator("exclude")
def exclude(df: DataFrame, **config) -> Effect:
    """Drop the rows that match."""
    found = matcher(df, **config)
    return Effect(df, keep=found.absent, applied=found.found)


def draw(rate: float, seed: int | None, keys: list[str] | None) -> Column:
    """True for about ``rate`` of the rows.

    With ``keys`` the decision is a hash of these columns: the same rows on every run and every
    retry.  Without, it is a seeded random number per row.
    """
    if rate <= 0:
        return F.lit(False)
    if rate >= 1:
        return F.lit(True)
    if keys:
        digest = F.md5(F.concat_ws("|", *[tx.field(k).cast("string") for k in keys]).cast("binary"))
        # 60 bits: as fine as a double's rate
        number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
        return number < F.lit(round(rate * 2**60))
    return F.rand(DEFAULT_SEED if seed is None else int(seed)) <= rate


@operator("drop")
def drop(
    df: DataFrame,
    if_field: str | None = None,
    equals: Any = None,
    not_equals: Any = None,
    contains: str | None = None,
    matches: str | None = None,
    unless_field: str | None = None,
    unless_equals: Any = None,
    unless_matches: str | None = None,
    percentage: float | None = None,
    always_drop: bool = False,
    seed: int | None = None,
    key: str | list[str] | None = None,
) -> Effect:
    """Drop matching rows, a percentage of them, or all rows but the protected ones."""
    require(
        always_drop or if_field is not None or unless_field is not None or percentage is not None,
        "drop needs if_field, unless_field, percentage or always_drop",
    )
    require(percentage is None or 0 <= percentage <= 100, f"percentage must be between 0 and 100, got {percentage}")
    if always_drop:
        return Effect(df, keep=F.lit(False))
    protected = matcher(df, field=unless_field, equals=unless_equals, matches=unless_matches)
    keep: list[Column] = [protected.found] if protected.conditions else []
    if if_field:
        doomed = matcher(df, field=if_field, equals=equals, contains=contains, matches=matches)
        if not_equals is not None and tx.has(df, if_field):
            doomed.conditions.append((tx.field(if_field), ~tx.equals(df, if_field, not_equals)))
        keep.append(doomed.absent)
    # Without if_field all rows are meant: "drop all except" with unless_*, thinning with a percentage.
    if percentage:
        keys = [key] if isinstance(key, str) else key
        keep.append(~draw(percentage / 100.0, seed, keys))
    elif percentage is not None and not if_field and not unless_field:
        keep.append(F.lit(True))
    kept = reduce(lambda a, b: a | b, keep) if keep else F.lit(False)
    return Effect(df, keep=kept, applied=~tx.is_true(kept))


def _number(df: DataFrame, name: str) -> Column:
    return tx.field(name).try_cast("double")


_ORDER = {
    "gt": lambda a, b: a > b,
    "gte": lambda a, b: a >= b,
    "lt": lambda a, b: a < b,
    "lte": lambda a, b: a <= b,
}


def _compare(df: DataFrame, name: str, op: str, value: Any) -> Column:
    """Ordering of a field and a number; a numeric column is compared as it is, so the scan can use it."""
    try:
        bound = value if tx.is_number(value) else float(value)
    except (TypeError, ValueError):
        return F.lit(False)
    column = tx.field(name) if isinstance(tx.type_of(df, name), tx.NUMERIC) else _number(df, name)
    return _ORDER[op](column, F.lit(bound))


@operator("conditional")
def conditional(df: DataFrame, field: str, operator: str, value: Any = None, action: str = "keep") -> Effect:
    """Keep or drop rows by one comparison."""
    names = ("eq", "ne", "contains", "not_contains", "exists", "not_exists", *_ORDER)
    require(operator in names, f"invalid operator {operator!r}")
    require(operator in ("exists", "not_exists") or value is not None, "conditional needs 'value'")
    present = tx.has(df, field)
    if operator in ("exists", "not_exists"):
        met = tx.field(field).isNotNull() if present else F.lit(False)
        met = ~met if operator == "not_exists" else met
    elif not present:
        met = F.lit(operator in ("ne", "not_contains"))
    elif operator in ("eq", "ne"):
        same = tx.equals(df, field, value)
        met = tx.field(field).isNull() | ~same if operator == "ne" else same
    elif operator in ("contains", "not_contains"):
        inside = tx.field_text(df, field).contains(tx.config_text(value))
        met = tx.field(field).isNull() | ~inside if operator == "not_contains" else inside
    else:
        met = _compare(df, field, operator, value)
    if action == "keep":
        return Effect(df, keep=met)
    # Where only a missing field makes the condition NULL, the negation can stay a plain comparison.
    plain = present and (operator in ("eq", "contains") or isinstance(tx.type_of(df, field), tx.NUMERIC))
    unmet = tx.field(field).isNull() | ~met if plain else ~tx.is_true(met)
    return Effect(df, keep=unmet if action == "drop" else F.lit(True))


@operator("conditional_field")
def conditional_field(
    df: DataFrame,
    field: str,
    operator: str = "equals",
    value: Any = None,
    action: str = "remove",
    replace_with: Any = None,
) -> Effect:
    """Remove, replace or null a field, or keep / drop the row, when the field meets a condition.

    A row without the field is left alone (``not_exists`` aside).
    """
    operators = ("equals", "not_equals", "contains", "starts_with", "ends_with", "matches", "exists", "not_exists")
    require(bool(field), "conditional_field needs 'field'")
    require(operator in operators or operator in _ORDER, f"invalid operator {operator!r}")
    require(operator in ("exists", "not_exists") or value is not None, f"'value' is required for {operator!r}")
    require(action in ("remove", "replace", "set_null", "drop_record", "keep_record"), f"invalid action {action!r}")
    require(action != "replace" or replace_with is not None, "'replace_with' is required for 'replace'")
    if operator == "matches":
        require(isinstance(value, str), "'value' must be a string for 'matches'")
        rx.compile_pattern(value)
    present = tx.has(df, field)
    exists = tx.field(field).isNotNull() if present else F.lit(False)
    relevant = exists
    if operator == "exists":
        met = exists
    elif operator == "not_exists":
        met, relevant = ~exists, ~exists
    elif not present:
        met = F.lit(False)
    elif operator in _ORDER:
        numeric = isinstance(tx.type_of(df, field), tx.NUMERIC) and tx.is_number(value)
        met = _ORDER[operator](tx.field(field), F.lit(value)) if numeric else F.lit(False)
    else:
        shown, wanted = tx.field_text(df, field), tx.config_text(value)
        met = {
            "equals": lambda: tx.equals(df, field, value),
            "not_equals": lambda: ~tx.equals(df, field, value),
            "contains": lambda: shown.contains(wanted),
            "starts_with": lambda: shown.startswith(wanted),
            "ends_with": lambda: shown.endswith(wanted),
            "matches": lambda: rx.matches(shown, wanted),
        }[operator]()
    if action in ("drop_record", "keep_record"):
        wanted = ~met if action == "drop_record" else met
        if present and operator not in ("exists", "not_exists"):
            keep = tx.field(field).isNull() | wanted
        else:
            keep = ~relevant | wanted
        return Effect(df, keep=keep, applied=tx.is_true(met) if action == "drop_record" else relevant)
    met = tx.is_true(met)
    if not present:
        filled = {field: F.when(met, literal(replace_with))} if action == "replace" else {}
        return Effect(df, sets=filled, applied=met if filled else F.lit(False))
    if action in ("remove", "set_null"):
        return Effect(df, sets={field: F.when(~met, tx.field(field))}, applied=met)
    new = literal(replace_with)
    kind = tx.type_of(df, field)
    if isinstance(kind, T.StringType):
        new = F.lit(tx.config_text(replace_with)) if not isinstance(replace_with, str) else F.lit(replace_with)
        result = F.when(met, new).otherwise(tx.field(field))
    elif isinstance(replace_with, str):
        result = F.when(met, new).otherwise(tx.field_text(df, field))
    else:
        result = F.when(met, new).otherwise(tx.field(field))
    return Effect(df, sets={field: result}, applied=met)


@operator("json_validate")
def json_validate(df: DataFrame, source_field: str = "message", fail_on_invalid: bool = True) -> Effect:
    """Drop rows whose field is missing or no valid JSON (scalars are valid)."""
    source_field = source_field or "message"
    valid = js.is_json(tx.field_text(df, source_field)) if tx.has(df, source_field) else F.lit(False)
    if not fail_on_invalid:
        return Effect(df, applied=valid)
    return Effect(df, keep=valid)


@operator("sample")
def sample(
    df: DataFrame,
    percentage: float | None = None,
    rate: float | None = None,
    seed: int | None = None,
    key: str | list[str] | None = None,
) -> Effect:
    """Keep a fraction of the rows, at random or (``key``) by a hash that repeats exactly."""
    require(percentage is not None or rate is not None, "sample needs 'percentage' or 'rate'")
    require(percentage is None or 0 <= percentage <= 100, f"percentage must be between 0 and 100, got {percentage}")
    require(rate is None or 0 <= rate <= 1, f"rate must be between 0.0 and 1.0, got {rate}")
    share = rate if rate is not None else percentage / 100.0
    return Effect(df, keep=draw(share, seed, [key] if isinstance(key, str) else key))
