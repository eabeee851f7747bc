"""The date_parse step: texts in several layouts, or epoch numbers, to RFC 3339 text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as dt
from ..functions import text as tx
from .effect import Effect, once, operator, unchanged

# The layouts tried when none is configured.
DEFAULT_LAYOUTS = ["2006-01-02T15:04:05Z07:00", "2006-01-02 15:04:05", "02/Jan/2006:15:04:05 -0700"]
UNIX_UNITS = ("unix_ms", "unix_us", "unix_ns")


def parsed(value: Column, layouts: list[str], timezone: str) -> Column:
    """Timestamp of a text by the first layout that fits, NULL if none does."""
    value = tx.trim_space(value)
    number = F.when(value.rlike(r"\A[+-]?\d+\z"), value.try_cast("bigint"))
    tries: list[Column] = []
    blocked: Column | None = None
    for layout in layouts:
        if layout == "unix":
            attempt = dt.unix_auto(number)
        elif layout in UNIX_UNITS:
            attempt = dt.unix_unit(number, layout)
        else:
            attempt = dt.parse_layout(value, layout, timezone)
        tries.append(attempt if blocked is None else F.when(~blocked, attempt))
        if layout == "unix" and blocked is None:
            # A negative number ends the search here: it is no valid epoch.
            blocked = F.coalesce(number < 0, F.lit(False))
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


@operator("date_parse")
def date_parse(
    df: DataFrame,
    source_field: str = "timestamp",
    target_field: str = "@timestamp",
    format: str | None = None,
    formats: list[str] | None = None,
    timezone: str = "UTC",
    locale: str | None = None,
    legacy_utc: bool = False,
    as_timestamp: bool = False,
) -> Effect:
    """Set ``target_field`` to the parsed time; rows that do not parse are left alone.

    Zone-less text is read in ``timezone`` (as UTC with ``legacy_utc``) and the result is shown
    there.  ``as_timestamp`` keeps a TIMESTAMP instead of the RFC 3339 text.
    """
    if not tx.has(df, source_field):
        return unchanged(df)
    layouts = list(formats) if formats else [format] if format else DEFAULT_LAYOUTS
    read_zone = "UTC" if legacy_utc else timezone
    kind = tx.type_of(df, source_field)
    if tx.is_string(df, source_field):
        stamp = parsed(tx.field(source_field), layouts, read_zone)
    elif isinstance(kind, tx.NUMERIC):
        stamp = dt.unix_auto(tx.field(source_field).try_cast("bigint"))
    elif kind.simpleString() == "timestamp":
        stamp = tx.field(source_field)
    elif kind.simpleString() == "timestamp_ntz":
        stamp = F.to_utc_timestamp(
            F.from_utc_timestamp(tx.field(source_field).cast("timestamp"), F.current_timezone()), F.lit(read_zone)
        )
    else:
        return unchanged(df)
    prepared = once(df, "_parsed", stamp)
    value = tx.field("_parsed") if as_timestamp else dt.rfc3339(tx.field("_parsed"), timezone)
    if tx.has(df, target_field):
        if as_timestamp:
            value = F.coalesce(value, tx.field(target_field).try_cast("timestamp"))
        else:
            value = F.coalesce(value, tx.field_text(df, target_field))
    return Effect(prepared, sets={target_field: value}, applied=tx.field("_parsed").isNotNull(), temps=("_parsed",))
