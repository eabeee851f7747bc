"""Reference-time date layouts (``2006-01-02 15:04:05``) compiled to one regex and one Spark pattern."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import quote_regex

_MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_LONG_MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
_DAYS = "mon|tue|wed|thu|fri|sat|sun"
_LONG_DAYS = "monday|tuesday|wednesday|thursday|friday|saturday|sunday"

# Layout token -> (part, regex of the text it reads, Spark pattern for that text).
# Tokens are tried in this order, so longer spellings come before their prefixes.
LAYOUT_TOKENS = [
    ("January", "month", f"(?i:{_LONG_MONTHS})", "MMMM"),
    ("Jan", "month", f"(?i:{_MONTHS})", "MMM"),
    ("Monday", None, f"(?i:{_LONG_DAYS})", None),
    ("Mon", None, f"(?i:{_DAYS})", None),
    ("MST", "abbreviation", r"(?:[A-Z]{3,4}|GMT[+-]\d{1,2})", None),
    ("2006", "year", r"\d{4}", "yyyy"),
    ("-07:00:00", "offset", r"[+-]\d{2}:\d{2}:\d{2}", "xxxxx"),
    ("-07:00", "offset", r"[+-]\d{2}:\d{2}", "xxx"),
    ("-0700", "offset", r"[+-]\d{4}", "xx"),
    ("-07", "offset", r"[+-]\d{2}", "x"),
    ("Z07:00", "offset", r"(?:Z|[+-]\d{2}:\d{2})", "XXX"),
    ("Z0700", "offset", r"(?:Z|[+-]\d{4})", "XX"),
    ("Z07", "offset", r"(?:Z|[+-]\d{2})", "X"),
    ("002", "yearday", r"\d{3}", "DDD"),
    ("01", "month", r"\d{2}", "MM"),
    ("02", "day", r"\d{2}", "dd"),
    ("03", "hour12", r"\d{2}", "hh"),
    ("04", "minute", r"\d{2}", "mm"),
    ("05", "second", r"\d{2}", "ss"),
    ("06", "shortyear", r"\d{2}", "yy"),
    ("15", "hour", r"\d{1,2}", "H"),
    ("_2", "day", r" ?\d{1,2}", "d"),
    ("PM", "half", r"[AP]M", "a"),
    ("pm", "half", r"[ap]m", "a"),
    ("1", "month", r"\d{1,2}", "M"),
    ("2", "day", r"\d{1,2}", "d"),
    ("3", "hour12", r"\d{1,2}", "h"),
    ("4", "minute", r"\d{1,2}", "m"),
    ("5", "second", r"\d{1,2}", "s"),
]

_FRACTION = re.compile(r"[.,](0+|9+)(?![0-9])")


@dataclass(frozen=True)
class Layout:
    """``regex`` tests and takes apart the text, ``template`` reorders it for ``spark_pattern``."""

    regex: str
    template: str
    spark_pattern: str
    zoned: bool
    short_year: bool


def compile_layout(layout: str) -> Layout:
    regex, groups = [], []
    pos = 0
    while pos < len(layout):
        fraction = _FRACTION.match(layout, pos)
        if fraction and groups and groups[-1][0] == "second" and regex[-1] == "(?:[.,]\\d+)?":
            if fraction.group(1).startswith("0"):
                regex[-1] = rf"[.,]\d{{{len(fraction.group(1))}}}"
            pos = fraction.end()
            continue
        token = next((t for t in LAYOUT_TOKENS if layout.startswith(t[0], pos)), None)
        if token and token[0] in ("Jan", "Mon") and layout[pos + 3 : pos + 4].islower():
            token = None
        if token is None:
            regex.append(r" +" if layout[pos] == " " else quote_regex(layout[pos]))
            pos += 1
            continue
        spelling, part, text_regex, spark = token
        if spark is None:
            regex.append(f"(?:{text_regex})")
        else:
            # The blank that pads a one-digit day stays outside the captured group.
            lead, body = (" ?", text_regex[2:]) if text_regex.startswith(" ?") else ("", text_regex)
            regex.append(f"{lead}({body})")
            groups.append((part, spark))
            if part == "second":
                # A fraction may follow the seconds even where the layout has none.
                regex.append("(?:[.,]\\d+)?")
        pos += len(spelling)
    template = " ".join(f"${i}" for i in range(1, len(groups) + 1))
    parts = [g[0] for g in groups]
    return Layout(
        regex=r"\A" + "".join(regex) + r"\z",
        template=template,
        spark_pattern=" ".join(g[1] for g in groups),
        zoned="offset" in parts,
        short_year="shortyear" in parts,
    )


def _shift(value: Column, to_zone: str) -> Column:
    """Instant whose wall time in ``to_zone`` equals the session wall time of ``value``."""
    return F.to_utc_timestamp(F.from_utc_timestamp(value, F.current_timezone()), F.lit(to_zone))


def parse_layout(value: Column, layout: str, timezone: str) -> Column:
    """Timestamp of a text in the given layout, NULL if it does not fit.

    Text without a numeric offset is read in ``timezone``; a zone abbreviation reads as UTC.
    """
    compiled = compile_layout(layout)
    ordered = F.regexp_replace(value, compiled.regex, compiled.template)
    stamp = F.try_to_timestamp(ordered, F.lit(compiled.spark_pattern))
    if not compiled.zoned:
        stamp = _shift(stamp, "UTC" if "MST" in layout else timezone)
    if compiled.short_year:
        century = F.when(F.year(stamp) >= 2069, F.lit(-1200)).otherwise(F.lit(0))
        stamp = stamp + F.make_ym_interval(F.lit(0), century)
    # The regex decides, so that the parser seldom has to raise and recover.
    return F.when(value.rlike(compiled.regex), stamp)


def rfc3339(value: Column, timezone: str) -> Column:
    """Text of an instant in ``timezone``: seconds precision, ``Z`` for a zero offset."""
    local = F.from_utc_timestamp(value, F.lit(timezone))
    shown = F.date_format(F.to_utc_timestamp(local, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
    if timezone == "UTC":
        return F.concat(shown, F.lit("Z"))
    minutes = F.floor((F.unix_micros(local) - F.unix_micros(value)) / 60000000)
    size = F.abs(minutes)
    offset = F.when(minutes == 0, F.lit("Z")).otherwise(
        F.concat(
            F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
            F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad((size % 60).cast("string"), 2, "0"),
        )
    )
    return F.concat(shown, offset)


def _scaled(value: Column, per_second: int) -> Column:
    """Timestamp of a count of 1/per_second seconds; NULL outside Spark's range."""
    if per_second <= 1000000:
        factor = 1000000 // per_second
        micros = F.when(F.abs(value) <= 9000000000000000000 // factor, value * factor)
    else:
        unit = F.lit(per_second // 1000000).cast("bigint")
        micros = F.call_function("div", value - F.pmod(value, unit), unit)
    return F.timestamp_micros(micros)


def unix_auto(value: Column) -> Column:
    """Timestamp of a non-negative epoch number whose unit follows from its size."""
    return (
        F.when(value < 0, F.lit(None).cast("timestamp"))
        .when(value <= 1000000000000, _scaled(value, 1))
        .when(value < 1000000000000000, _scaled(value, 1000))
        .when(value < 1000000000000000000, _scaled(value, 1000000))
        .otherwise(_scaled(value, 1000000000))
    )


def unix_unit(value: Column, unit: str) -> Column:
    return _scaled(value, {"unix_ms": 1000, "unix_us": 1000000, "unix_ns": 1000000000}[unit])
