"""IP address text as 32 hexadecimal digits, so that address ranges compare as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Fixed value: the prefix that maps an IPv4 address into the IPv6 space.
V4_PREFIX = "00000000000000000000ffff"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
V4_PATTERN = rf"\A(?:{_OCTET}\.){{3}}{_OCTET}\z"
V6_PATTERN = r"\A(?:[0-9A-Fa-f]{1,4})?(?::{1,2}[0-9A-Fa-f]{1,4})*(?:::)?\z"


def _v4_hex(value: Column) -> Column:
    octets = F.split(value, r"\.")
    octet = lambda i: F.get(octets, F.lit(i)).cast("bigint")
    number = octet(0) * 16777216 + octet(1) * 65536 + octet(2) * 256 + octet(3)
    return F.lower(F.lpad(F.hex(number), 8, "0"))


def _groups(value: Column) -> Column:
    return F.filter(F.split(value, ":"), lambda g: g != "")


def _v6_hex(value: Column) -> Column:
    """Hex form of IPv6 text without an embedded IPv4 tail; NULL when malformed."""
    gap = F.instr(value, "::")
    left = _groups(F.when(gap > 0, F.substring_index(value, "::", 1)).otherwise(value))
    right = F.when(gap > 0, _groups(F.substring_index(value, "::", -1))).otherwise(F.array().cast("array<string>"))

    def build(parts: Column) -> Column:
        missing = F.lit(8) - F.size(parts["l"]) - F.size(parts["r"])
        fits = F.when(parts["gap"] > 0, missing >= 1).otherwise(missing == 0)
        filled = F.concat(parts["l"], F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), parts["r"])
        digits = F.lower(F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), ""))
        return F.when(fits, digits)

    built = let(F.struct(left.alias("l"), right.alias("r"), gap.alias("gap")), build)
    twice = F.length(value) - F.length(F.replace(value, F.lit("::"))) > 2
    bare_end = value.rlike(r"(?:^:[^:])|(?:[^:]:$)|:::")
    return F.when(value.rlike(V6_PATTERN) & value.contains(":") & ~twice & ~bare_end, built)


def ip_hex(value: Column) -> Column:
    """32 lower-case hex digits of an IPv4 or IPv6 address text, NULL for anything else."""
    tail = F.regexp_extract(value, r":((?:\d{1,3}\.){3}\d{1,3})\z", 1)
    mixed = let(
        tail,
        lambda t: F.when(
            t.rlike(V4_PATTERN),
            let(
                _v4_hex(t),
                lambda h: _v6_hex(
                    F.concat(
                        F.left(value, F.length(value) - F.length(t)),
                        F.left(h, F.lit(4)),
                        F.lit(":"),
                        F.right(h, F.lit(4)),
                    )
                ),
            ),
        ),
    )
    return (
        F.when(value.rlike(V4_PATTERN), F.concat(F.lit(V4_PREFIX), _v4_hex(value)))
        .when(value.contains(":") & value.contains("."), mixed)
        .when(value.contains(":"), _v6_hex(value))
    )

