"""Catalogued queries over the test tables, one or more per operator, with DuckDB equivalents."""

from . import chains, edits, filters, lookups, parsing, rows, streams, summaries, transfer  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
