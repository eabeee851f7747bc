"""Chain specifications: ``{"enabled": true, "filters": [{"type", "config", "enabled", "condition"}]}``."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from ..operators import dates, enrich, fields, grok, kv, mutate, parse, predicates, rows  # noqa: F401  (register steps)
from ..operators.effect import BUILDERS, Effect
from ..operators.parse import PARSERS, Parser

# Options that are accepted for compatibility and do nothing.
IGNORED = {
    "date_parse": ("locale",),
    "grok": ("named_captures_only",),
    "enricher": ("tenant_id", "cache_ttl"),
    "dns": ("nameserver", "timeout", "cache_size", "cache_ttl"),
}
NEED_TABLES = ("enricher", "geoip", "dns")
NEED_CONTEXT = ("add_field",)
DEFAULT_PROCESSED_BY = "eventflow"
DEFAULT_VERSION = "default-1.0"


@dataclass(frozen=True)
class FilterSpec:
    type: str
    config: dict[str, Any] = field(default_factory=dict)
    enabled: bool = True
    condition: str | None = None


@dataclass(frozen=True)
class ChainSpec:
    filters: tuple[FilterSpec, ...] = ()
    enabled: bool = True
    config_key: str = ""

    @property
    def active(self) -> tuple[FilterSpec, ...]:
        return tuple(f for f in self.filters if f.enabled) if self.enabled else ()


def as_spec(source: ChainSpec | dict | str | list) -> ChainSpec:
    """Specification from JSON text, a dict, or a plain list of filters."""
    if isinstance(source, ChainSpec):
        return source
    if isinstance(source, str):
        source = json.loads(source)
    if isinstance(source, list):
        source = {"filters": source}
    filters = tuple(
        FilterSpec(f["type"], dict(f.get("config") or {}), bool(f.get("enabled", True)), f.get("condition") or None)
        for f in source.get("filters") or []
    )
    return ChainSpec(filters, bool(source.get("enabled", True)), source.get("config_key", ""))


def default_spec(processed_by: str = DEFAULT_PROCESSED_BY, version: str = DEFAULT_VERSION) -> ChainSpec:
    """The chain of a dataset without a specification of its own."""
    return as_spec(
        [
            {"type": "add_field", "config": {"field": "processed_by", "value": processed_by}},
            {"type": "add_field", "config": {"field": "pipeline_version", "value": version}},
        ]
    )


CUSTOM_FILTERS: dict[str, tuple[Callable[[DataFrame, dict[str, Any]], DataFrame | Effect], bool]] = {}


def register_filter(name: str, function: Callable[[DataFrame, dict[str, Any]], DataFrame | Effect], rows: bool = False) -> None:
    """Make a DataFrame function available as a filter type.

    It edits columns; a condition then puts old values back, in one pass.  A function that drops or adds rows returns an
    :class:`Effect` (``keep``, ``explode``), or is registered with ``rows``: with a condition such a step
    reads its input twice.
    """
    CUSTOM_FILTERS[name] = function, rows


def register_parser(name: str, parser: Parser) -> None:
    """Make a function from a text column (and settings) to a struct column available as a parser."""
    PARSERS[name] = parser


def build_effect(
    df: DataFrame,
    spec: FilterSpec,
    tables: dict[str, DataFrame] | None = None,
    context: dict[str, Any] | None = None,
) -> Effect:
    """Effect of one filter on ``df``; raises ValueError for a bad type or configuration."""
    config = dict(spec.config)
    if spec.type in CUSTOM_FILTERS:
        function, rows = CUSTOM_FILTERS[spec.type]
        made = None if rows else function(df, config)
        return made if isinstance(made, Effect) else Effect(df, whole=lambda d: function(d, config), local=not rows)
    if spec.type not in BUILDERS:
        raise ValueError(f"unknown filter type {spec.type!r}")
    for option in IGNORED.get(spec.type, ()):
        if option in config:
            warnings.warn(f"{spec.type}: option {option!r} has no effect", stacklevel=2)
    if spec.type in NEED_TABLES:
        config["tables"] = tables
    if spec.type in NEED_CONTEXT:
        config.update(context or {})
    try:
        return BUILDERS[spec.type](df, **config)
    except TypeError as error:
        raise ValueError(f"{spec.type}: {error}") from error


def validate_spec(
    source: ChainSpec | dict | str | list, df: DataFrame, tables: dict[str, DataFrame] | None = None
) -> list[str]:
    """Problems of a specification against the schema of ``df``; an empty list means it compiles."""
    problems = []
    for position, spec in enumerate(as_spec(source).filters):
        if not spec.enabled:
            continue
        try:
            df = build_effect(df, spec, tables).run()
        except Exception as error:  # noqa: BLE001  (every problem is reported, not raised)
            problems.append(f"filter {position} ({spec.type}): {error}")
    return problems
