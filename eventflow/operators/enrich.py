"""Look-ups: enricher tables, address ranges, name resolution and user agents.

A look-up side is broadcast only after its size was checked.  Beyond that size the rows are
joined by a shuffle in which hot and missing keys are spread over many partitions.
"""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import net
from ..functions import regex as rx
from ..functions import text as tx
from ..session import stored
from .effect import Effect, once, operator, require, unchanged
from .range_sweep import narrowest

# Largest look-up side that is broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
# Partitions that rows without a key are dealt to.
SPREAD = 4096
RANGE_SALTS = 16
# Most ranges that may touch one bucket of addresses for the bucketed join; a row is compared with all of its bucket.
BUCKET_RANGES = 64


def fits_broadcast(lookup: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether a look-up table is small, by reading at most ``max_rows + 1`` of its rows."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    row = F.to_json(F.struct(*[tx.field(c) for c in lookup.columns]))
    size = lookup.limit(max_rows + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(row)), F.lit(0)).alias("bytes")
    ).first()
    return size["n"] <= max_rows and size["bytes"] <= max_bytes


def first_per_key(lookup: DataFrame, key: str, order: str | list[str]) -> DataFrame:
    """First row of every key in the given order, as ``_key`` and the struct ``_row``.

    An aggregate with partial results, so a key repeated in many rows is reduced before the shuffle.
    """
    order = [order] if isinstance(order, str) else list(order)
    columns = [c for c in lookup.columns if not c.startswith("_order")]
    row = F.struct(*[tx.field(c) for c in columns])
    position = F.struct(*[tx.field(o) for o in order])
    keyed = lookup.withColumn("_key", tx.field_text(lookup, key)).where(F.col("_key").isNotNull())
    return keyed.groupBy("_key").agg(F.min_by(row, position).alias("_row"))


def lookup_join(df: DataFrame, key: Column, lookup: DataFrame, broadcast: bool, out: str = "_found") -> DataFrame:
    """Left join of a unique-key look-up (``_key``, ``_row``); the match is in column ``out``."""
    right = lookup.select(F.col("_key").alias("_rkey"), F.col("_row").alias(out))
    marked = df.withColumn("_lkey", key)
    if broadcast:
        return marked.join(F.broadcast(right), F.col("_lkey") == F.col("_rkey"), "left").drop("_lkey", "_rkey")
    right_slotted = right.withColumn("_rslot", F.lit(0)).hint("merge")
    matches = (F.col("_lkey") == F.col("_rkey")) & (F.col("_slot") == F.col("_rslot"))
    # The partition id depends on the row's task alone, so a retried task spreads alike.
    slot = 1 + F.spark_partition_id() % SPREAD
    # Rows without a key go to many partitions, where they match nothing; hot keys are split by adaptive execution,
    # since both sides are plain exchanges of this join.
    near = marked.withColumn("_slot", F.when(F.col("_lkey").isNull(), slot).otherwise(0))
    return near.join(right_slotted, matches, "left").select(*[tx.field(c) for c in df.columns], tx.field(out))


def _table(tables: dict[str, DataFrame] | None, name: str) -> DataFrame:
    require(bool(tables) and name in tables, f"no look-up table {name!r} was given")
    return tables[name]


@operator("enricher")
def enricher(
    df: DataFrame,
    source_field: str,
    enricher_id: str | None = None,
    enrichment: str | None = None,
    enricher_name: str | None = None,
    tenant_id: str | None = None,
    target_field: str | None = None,
    index_column: str | None = None,
    order_by: str | list[str] | None = None,
    cache_ttl: float | None = None,
    tables: dict[str, DataFrame] | None = None,
    broadcast: bool | None = None,
) -> Effect:
    """Put the first look-up row whose index column equals the text of ``source_field`` into a struct.

    ``index_column`` is the first column of the table by default, ``order_by`` (default: all
    columns) says which of several equal keys is first.
    """
    name = enricher_id or enrichment
    require(bool(name), "enricher needs 'enricher_id'")
    require(bool(source_field), "enricher needs 'source_field'")
    if not tx.has(df, source_field):
        return unchanged(df)
    lookup = _table(tables, name)
    index = index_column or lookup.columns[0]
    unique = first_per_key(lookup, index, order_by or lookup.columns)
    small = fits_broadcast(lookup) if broadcast is None else broadcast
    target = target_field or f"src.{source_field}-{enricher_name or name}"
    joined = lookup_join(df, tx.field_text(df, source_field), unique, small)
    found = tx.field("_found")
    value = found
    if tx.has(df, target) and tx.type_of(df, target) == tx.type_of(joined, "_found"):
        value = F.coalesce(found, tx.field(target))
    return Effect(joined, sets={target: value}, applied=found.isNotNull(), temps=("_found",))


@operator("dns")
def dns(
    df: DataFrame,
    resolve: list[str],
    action: str = "replace",
    target_field: str | None = None,
    table: str = "dns",
    tables: dict[str, DataFrame] | None = None,
    broadcast: bool | None = None,
    **ignored: Any,
) -> Effect:
    """Resolve names or addresses by a table of ``name`` and ``resolved``; unresolved stays unchanged."""
    lookup = _table(tables, table)
    unique = first_per_key(lookup.select("name", "resolved"), "name", "resolved")
    small = fits_broadcast(lookup) if broadcast is None else broadcast
    names = [n for n in dict.fromkeys(resolve) if tx.is_string(df, n)]
    if not names:
        return unchanged(df)
    if small or len(names) == 1 or df.isStreaming:
        # one exchange at most
        out, found = df, {}
        for i, name in enumerate(names):
            out = lookup_join(out, tx.field(name), unique, small, f"_dns_{i}")
            found[name] = tx.field(f"_dns_{i}").getField("resolved")
        temps = tuple(f"_dns_{i}" for i in range(len(names)))
    else:
        out, found, temps = _resolved_together(df, names, unique)
    sets, applied = {}, []
    for name in names:
        target = target_field or (name + "_resolved" if action == "append" else name)
        before = sets.get(target, tx.field_text(df, target) if tx.has(df, target) else None)
        sets[target] = found[name] if before is None else F.coalesce(found[name], before)
        applied.append(found[name].isNotNull())
    return Effect(out, sets=sets, applied=tx.any_of(applied), temps=temps)


def _resolved_together(df: DataFrame, names: list[str], unique: DataFrame) -> tuple[DataFrame, dict[str, Column], tuple[str, ...]]:
    """All fields by one join with a large table: the distinct tuples of values, exploded, resolved and put together again.

    The wide rows are shuffled once, by the hash of their tuple, however many fields there are.
    """
    values = F.array(*[tx.field(n) for n in names])
    tuples = df.select(values.alias("_values")).distinct()
    each = tuples.select("_values", F.explode(F.array_distinct("_values")).alias("_value")).where("_value IS NOT NULL")
    hits = lookup_join(each, F.col("_value"), unique, False).where("_found IS NOT NULL")
    listed = hits.groupBy("_values").agg(F.map_from_entries(F.collect_list(F.struct("_value", "_found.resolved"))).alias("m"))
    look_up = listed.select(F.to_json("_values").alias("_key"), F.struct("m").alias("_row"))
    out = lookup_join(df, F.to_json(values), look_up, False, "_dns")
    found = {n: F.try_element_at(tx.field("_dns").getField("m"), tx.field(n)) for n in names}
    return out, found, ("_dns",)


# Selectable field -> (key in the result, column of the range table).
GEO_FIELDS = {
    "country": ("country", "country_name"),
    "country_name": ("country", "country_name"),
    "country_code": ("country_code", "country_code"),
    "country_iso_code": ("country_code", "country_code"),
    "country_code2": ("country_code2", "country_code"),
    "country_code3": ("country_code3", "country_code"),
    "city": ("city", "city_name"),
    "city_name": ("city", "city_name"),
    "latitude": ("latitude", "latitude"),
    "longitude": ("longitude", "longitude"),
    "location": ("location", None),
    "timezone": ("timezone", "timezone"),
    "continent_name": ("continent_name", "continent_name"),
    "continent_code": ("continent_code", "continent_code"),
    "region_name": ("region_name", "region_name"),
    "subdivision_name": ("region_name", "region_name"),
    "region_code": ("region_code", "region_code"),
    "subdivision_code": ("region_code", "region_code"),
    "postal_code": ("postal_code", "postal_code"),
    "zip_code": ("postal_code", "postal_code"),
    "metro_code": ("metro_code", "metro_code"),
    "accuracy_radius": ("accuracy_radius", "accuracy_radius"),
}
GEO_DEFAULT = ["country_name", "city_name", "latitude", "longitude"]


def _bucket_of(ip: Column) -> Column:
    """First 16 bits of an IPv4 address, first 32 of an IPv6 one (both as hex text)."""
    return F.when(ip.startswith(net.V4_PREFIX), F.left(ip, F.lit(28))).otherwise(F.left(ip, F.lit(8)))


def _hex_number(value: Column) -> Column:
    return F.conv(value, 16, 10).cast("bigint")


def _with_bucket_numbers(ranges: DataFrame) -> DataFrame:
    """Add the numbers of the first and last bucket that a range touches, and whether that is many."""
    digits = lambda c: F.when(F.col("_v4"), F.substring(c, 25, 4)).otherwise(F.left(c, F.lit(8)))
    numbered = ranges.withColumn("_v4", F.col("_start").startswith(net.V4_PREFIX))
    numbered = numbered.withColumns({"_from": _hex_number(digits("_start")), "_to": _hex_number(digits("_end"))})
    return numbered.withColumn("_wide", F.col("_to") - F.col("_from") > 65536)


def _fine_buckets(ranges: DataFrame) -> DataFrame:
    """One row per range and bucket."""
    rows = ranges.where("NOT _wide").withColumn("_n", F.explode(F.sequence("_from", "_to")))
    number = F.lower(F.hex("_n"))
    bucket = F.when(F.col("_v4"), F.concat(F.lit(net.V4_PREFIX), F.lpad(number, 4, "0"))).otherwise(F.lpad(number, 8, "0"))
    return rows.select(bucket.alias("_bucket"), "_start", "_end", "_geo")


def _coarse_buckets(ranges: DataFrame) -> DataFrame:
    """The same by 16 bits, for the few ranges that touch too many fine buckets."""
    first = lambda c: _hex_number(F.left(c, F.lit(4)))
    rows = ranges.where("_wide").withColumn("_n", F.explode(F.sequence(first("_start"), first("_end"))))
    return rows.select(F.lpad(F.lower(F.hex("_n")), 4, "0").alias("_bucket"), "_start", "_end", "_geo")


def _disjoint(ranges: DataFrame) -> DataFrame:
    """Non-overlapping pieces of the ranges of each bucket; of several ranges around a piece the narrowest has it.

    A group holds the ranges that touch one bucket.  Addresses are texts of one length, so ``end`` and a mark above all
    digits stands for what follows ``end``.
    """
    high = lambda c, i: F.conv(F.substring(c, i, 8), 16, 10).cast("double")
    size = sum(((high("_end", 1 + 8 * i) - high("_start", 1 + 8 * i)) * 2.0 ** (32 * (3 - i)) for i in range(4)), F.lit(0.0))
    after = F.concat("_end", F.lit("~"))
    item = F.struct(size.alias("size"), F.col("_start").alias("a"), after.alias("b"), F.to_json("_geo").alias("tie"), F.col("_geo").alias("geo"))
    listed = ranges.groupBy("_bucket").agg(F.collect_list(item).alias("_all"))
    cuts = F.array_sort(F.array_distinct(F.concat(F.transform("_all", lambda r: r["a"]), F.transform("_all", lambda r: r["b"]))))
    listed = listed.withColumn("_cuts", cuts)

    def piece(cut: Column, i: Column) -> Column:
        over = F.filter("_all", lambda r: (r["a"] <= cut) & (r["b"] > cut))
        best = F.array_min(F.transform(over, lambda r: F.struct(r["size"].alias("size"), r["a"].alias("a"), r["tie"].alias("tie"))))
        own = F.filter(over, lambda r: (r["size"] == best["size"]) & (r["a"] == best["a"]) & (r["tie"] == best["tie"]))
        return F.struct(cut.alias("a"), F.get("_cuts", i + 1).alias("b"), F.get(own, 0)["geo"].alias("geo"))

    pieces = listed.select("_bucket", F.explode(F.transform("_cuts", piece)).alias("p")).where("p.geo IS NOT NULL")
    return pieces.select("_bucket", F.col("p.a").alias("_start"), F.col("p.b").alias("_end"), F.col("p.geo").alias("_geo"))


def _range_sizes(ranges: DataFrame) -> tuple[bool, bool, bool]:
    """Whether the fine and the coarse side are small enough to broadcast, and whether there are wide ranges."""
    buckets = F.col("_to") - F.col("_from") + 1
    row = F.octet_length(F.to_json("_geo")).cast("bigint") + 100
    sizes = ranges.agg(
        F.sum(F.when(~F.col("_wide"), buckets)).alias("rows"),
        F.sum(F.when(~F.col("_wide"), buckets * row)).alias("bytes"),
        F.count_if("_wide").alias("wide"),
        F.sum(F.when(F.col("_wide"), row)).alias("wide_bytes"),
    ).first()
    fine = (sizes["rows"] or 0) <= BROADCAST_ROWS and (sizes["bytes"] or 0) <= BROADCAST_BYTES
    # Wide ranges that do not overlap touch at most 65,536 coarse buckets plus one each.
    coarse = sizes["wide"] <= BROADCAST_ROWS and (sizes["wide_bytes"] or 0) <= BROADCAST_BYTES
    return fine, coarse, sizes["wide"] > 0


def _sparse(ranges: DataFrame) -> bool:
    """Whether no bucket is touched by more than BUCKET_RANGES ranges."""
    buckets = _fine_buckets(ranges).select("_bucket").union(_coarse_buckets(ranges).select("_bucket"))
    return buckets.groupBy("_bucket").count().where(F.col("count") > BUCKET_RANGES).isEmpty()


def _bucketed(located: DataFrame, ranges: DataFrame, small: bool, small_wide: bool, wide: bool) -> tuple[DataFrame, tuple[str, ...]]:
    """Join by address prefix and then by range: the input is read once, and a small look-up needs no shuffle."""
    located = _range_join(located, _bucket_of(F.col("_ip")), _fine_buckets(ranges), "_geo_fine", small)
    if not wide:
        return located, ("_geo_fine",)
    located = _range_join(located, F.left(F.col("_ip"), F.lit(4)), _coarse_buckets(ranges), "_geo_wide", small_wide)
    return located, ("_geo_fine", "_geo_wide")


def _swept(located: DataFrame, ranges: DataFrame, broadcast: bool | None) -> tuple[DataFrame, tuple[str, ...]]:
    """Sweep over the distinct addresses and the ranges, then join each row by its address."""
    unique = ranges.groupBy("_start", "_end").agg(F.min_by("_geo", F.to_json("_geo")).alias("_geo"))
    unique = stored(unique.select(F.unhex("_start").alias("_start"), F.unhex("_end").alias("_end"), "_geo"), "ranges")
    points = located.where(F.col("_ip").isNotNull()).select(F.unhex("_ip").alias("point")).distinct()
    found = narrowest(points, unique.select(F.col("_start").alias("start"), F.col("_end").alias("end")))
    side = F.broadcast(unique) if fits_broadcast(unique.withColumn("_start", F.hex("_start")).withColumn("_end", F.hex("_end"))) else unique
    known = found.join(side, (F.col("start") == F.col("_start")) & (F.col("end") == F.col("_end")))
    resolved = stored(known.select(F.lower(F.hex("point")).alias("_key"), F.col("_geo").alias("_row")), "resolved")
    small = fits_broadcast(resolved) if broadcast is None else broadcast
    return lookup_join(located, F.col("_ip"), resolved, small, "_geo_fine"), ("_geo_fine",)


def _range_join(df: DataFrame, bucket: Column, ranges: DataFrame, out: str, broadcast: bool) -> DataFrame:
    right = _disjoint(ranges).select(
        F.col("_bucket").alias("_rb"), F.col("_start").alias("_rs"), F.col("_end").alias("_re"), F.col("_geo").alias(out)
    )
    inside = (F.col("_ip") >= F.col("_rs")) & (F.col("_ip") < F.col("_re"))
    left = df.withColumn("_lb", bucket)
    if broadcast:
        joined = left.join(F.broadcast(right), (F.col("_lb") == F.col("_rb")) & inside, "left")
    else:
        # Rows of one hot bucket (or without an address) are dealt to RANGE_SALTS partitions each;
        # every range is there in as many copies.
        left = left.withColumn(
            "_ls",
            F.when(F.col("_lb").isNull(), F.lit(RANGE_SALTS) + F.spark_partition_id() % SPREAD).otherwise(
                F.spark_partition_id() % RANGE_SALTS
            ),
        )
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(RANGE_SALTS - 1))))
        joined = left.join(right, (F.col("_lb") == F.col("_rb")) & (F.col("_ls") == F.col("_salt")) & inside, "left")
    return joined.select(*[tx.field(c) for c in df.columns], tx.field(out))


@operator("geoip")
def geoip(
    df: DataFrame,
    source_field: str = "ip_address",
    target_field: str = "geoip",
    database: str = "geoip",
    fields: list[str] | None = None,
    tables: dict[str, DataFrame] | None = None,
    broadcast: bool | None = None,
) -> Effect:
    """Geographic record of an address from a table of ranges; of ranges that overlap the narrowest counts.

    The table has ``start_ip`` and ``end_ip`` (inclusive, IPv4 or IPv6 text) and any of the
    record columns.  ``source_field`` may be a dotted path.  An invalid or unknown address
    leaves the row unchanged.

    A small table without dense stretches is broadcast by address prefix.  Any other is swept: the distinct addresses
    and the ranges in order, then a join by address.  A stream, whose rows cannot be sorted, always takes the prefixes.
    """
    source = tx.nested(df, source_field)
    if source is None or not isinstance(df.select(source.alias("s")).schema["s"].dataType, T.StringType):
        return unchanged(df)
    table = _table(tables, database)
    members = {}
    for name in fields or GEO_DEFAULT:
        key, column = GEO_FIELDS.get(name, (None, None))
        if key == "location":
            if "latitude" in table.columns and "longitude" in table.columns:
                members[key] = F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
        elif key and column in table.columns:
            members[key] = F.col(column)
    geo = F.struct(*[c.alias(n) for n, c in members.items()]) if members else F.struct(F.lit(True).alias("known"))
    ranges = once(table.select("start_ip", "end_ip", geo.alias("_geo")), "_start", net.ip_hex(F.col("start_ip")))
    ranges = once(ranges, "_end", net.ip_hex(F.col("end_ip"))).where("_start <= _end").drop("start_ip", "end_ip")
    ranges = _with_bucket_numbers(ranges)
    located = once(df, "_ip", net.ip_hex(source))
    if df.isStreaming:
        small, small_wide, wide = (broadcast, broadcast, True) if broadcast is not None else _range_sizes(ranges)
        located, parts = _bucketed(located, ranges, small, small_wide, wide)
    else:
        small, small_wide, wide = (True, True, True) if broadcast else (False, False, True) if broadcast is False else _range_sizes(ranges)
        if small and small_wide and _sparse(ranges):
            located, parts = _bucketed(located, ranges, True, True, wide)
        else:
            located, parts = _swept(located, ranges, broadcast)
    found = F.coalesce(*[F.col(p) for p in parts])
    value = found
    if tx.has(df, target_field) and tx.type_of(df, target_field) == tx.type_of(located, "_geo_fine"):
        value = F.coalesce(found, tx.field(target_field))
    return Effect(located, sets={target_field: value}, applied=found.isNotNull(), temps=("_ip", *parts))


# A small rule list of our own; pass a fuller one as ``rules``.  Rules of a kind are tried in order.
# Groups 1 to 4 are family, major, minor and patch unless the rule says otherwise; a value may
# refer to groups as ``$1``.
AGENT_RULES: list[dict[str, str]] = [
    {"kind": "agent", "regex": r"(Googlebot|bingbot|YandexBot|AhrefsBot)(?:/(\d+)(?:\.(\d+))?)?"},
    {"kind": "agent", "regex": r"(curl|Wget|python-requests|okhttp)/(\d+)(?:\.(\d+)(?:\.(\d+))?)?"},
    {"kind": "agent", "regex": r"(Edg)(?:e|A|iOS)?/(\d+)(?:\.(\d+)(?:\.(\d+))?)?", "family": "Edge"},
    {"kind": "agent", "regex": r"(OPR)/(\d+)(?:\.(\d+)(?:\.(\d+))?)?", "family": "Opera"},
    {"kind": "agent", "regex": r"(Firefox)/(\d+)(?:\.(\d+)(?:\.(\d+))?)?"},
    {"kind": "agent", "regex": r"(Chrome)/(\d+)(?:\.(\d+)(?:\.(\d+))?)?\S* Mobile", "family": "$1 Mobile"},
    {"kind": "agent", "regex": r"(Chrome)/(\d+)(?:\.(\d+)(?:\.(\d+))?)?"},
    {"kind": "agent", "regex": r"(Version)/(\d+)(?:\.(\d+)(?:\.(\d+))?)? Mobile\S* Safari/", "family": "Mobile Safari"},
    {"kind": "agent", "regex": r"(Version)/(\d+)(?:\.(\d+)(?:\.(\d+))?)? Safari/", "family": "Safari"},
    {"kind": "os", "regex": r"(Android) (\d+)(?:\.(\d+)(?:\.(\d+))?)?"},
    {"kind": "os", "regex": r"(iPhone|iPad|iPod).*OS (\d+)[_.](\d+)(?:[_.](\d+))?", "family": "iOS"},
    {"kind": "os", "regex": r"(Windows) NT 10\.0", "major": "10"},
    {"kind": "os", "regex": r"(Windows) NT 6\.1", "major": "7"},
    {"kind": "os", "regex": r"(Windows)"},
    {"kind": "os", "regex": r"(Mac OS X) (\d+)[_.](\d+)(?:[_.](\d+))?"},
    {"kind": "os", "regex": r"(Ubuntu|Fedora)"},
    {"kind": "os", "regex": r"(Linux)"},
    {"kind": "device", "regex": r"(iPhone|iPad|iPod)", "brand": "Apple", "model": "$1"},
    {"kind": "device", "regex": r"; (SM-[A-Z0-9]+)", "family": "Samsung $1", "brand": "Samsung", "model": "$1"},
    {"kind": "device", "regex": r"; (Pixel \d+)", "brand": "Google", "model": "$1"},
]

# Operating systems that tell the device type when no device rule matched.
MOBILE_SYSTEMS = ["Android", "iOS", "Windows Phone", "BlackBerry OS"]
DESKTOP_SYSTEMS = ["Windows", "Mac OS X", "Linux", "Ubuntu", "Fedora"]


def _by_rules(agent: Column, rules: list[dict[str, str]], parts: list[str]) -> Column:
    """Struct of the first matching rule; one CASE with literal patterns, each compiled once per task."""
    standard = {"family": "$1", "major": "$2", "minor": "$3", "patch": "$4"}
    chain = None
    for rule in rules:
        pattern = rx.compile_pattern(rule["regex"])
        members = []
        for part in parts:
            pieces = re.split(r"\$(\d)", rule.get(part, standard.get(part, "")))
            filled = [
                F.lit(piece)
                if i % 2 == 0
                else F.regexp_extract(agent, pattern.java, int(piece))
                if int(piece) <= pattern.groups
                else F.lit("")
                for i, piece in enumerate(pieces)
                if piece
            ]
            members.append(F.nullif(F.concat(F.lit(""), *filled), F.lit("")).alias(part))
        chain = (F if chain is None else chain).when(agent.rlike(pattern.java), F.struct(*members))
    other = F.struct(*[(F.lit("Other") if p == "family" else F.lit(None).cast("string")).alias(p) for p in parts])
    return other if chain is None else chain.otherwise(other)


def matched_rules(agent: Column, rules: list[dict[str, str]]) -> Column:
    """Struct of the first matching agent, system and device rule."""
    of = lambda kind: [r for r in rules if r["kind"] == kind]
    parts = ["family", "major", "minor", "patch"]
    return F.struct(
        _by_rules(agent, of("agent"), parts).alias("a"),
        _by_rules(agent, of("os"), parts).alias("o"),
        _by_rules(agent, of("device"), ["family", "brand", "model"]).alias("d"),
    )


def agent_info(x: Column) -> Column:
    """Struct of browser, operating system and device out of :func:`matched_rules`."""
    dotted = lambda x: F.when(x["major"].isNotNull(), F.concat_ws(".", x["major"], x["minor"], F.when(x["minor"].isNotNull(), x["patch"])))
    a, o, d = x["a"], x["o"], x["d"]
    device = (
        F.when(d["family"] != "Other", d["family"])
        .when(o["family"].isin(MOBILE_SYSTEMS), "Mobile")
        .when(o["family"].isin(DESKTOP_SYSTEMS), "Desktop")
        .otherwise("Other")
    )
    return F.struct(
        a["family"].alias("name"),
        dotted(a).alias("version"),
        a["major"].alias("major"),
        F.when(a["major"].isNotNull(), a["minor"]).alias("minor"),
        F.when(a["major"].isNotNull(), a["patch"]).alias("patch"),
        o["family"].alias("os"),
        dotted(o).alias("os_version"),
        o["major"].alias("os_major"),
        F.when(o["major"].isNotNull(), o["minor"]).alias("os_minor"),
        device.alias("device"),
        d["brand"].alias("device_brand"),
        d["model"].alias("device_model"),
    )


@operator("useragent")
def useragent(
    df: DataFrame,
    source_field: str = "user_agent",
    target_field: str = "ua",
    rules: list[dict[str, str]] | None = None,
    distinct: bool = False,
    broadcast: bool | None = None,
) -> Effect:
    """Browser, operating system and device of a user-agent text, by an ordered rule list.

    The rules are evaluated per row without any join.  With ``distinct`` they are evaluated once
    per different text and joined back, which pays off for long rule lists on repetitive data.
    """
    if not tx.is_string(df, source_field):
        return unchanged(df)
    rules = AGENT_RULES if rules is None else rules
    agent = tx.field(source_field)
    if not distinct:
        prepared = once(df, "_ua", F.when(agent.isNotNull(), matched_rules(agent, rules)))
        info = F.when(F.col("_ua").isNotNull(), agent_info(F.col("_ua")))
        return Effect(prepared, sets={target_field: info}, applied=agent.isNotNull(), temps=("_ua",))
    agents = df.select(agent.alias("_key")).where(F.col("_key").isNotNull()).distinct()
    known = once(agents, "_ua", matched_rules(F.col("_key"), rules)).select("_key", agent_info(F.col("_ua")).alias("_row"))
    small = fits_broadcast(agents) if broadcast is None else broadcast
    joined = lookup_join(df, agent, known, small)
    return Effect(joined, sets={target_field: F.col("_found")}, applied=agent.isNotNull(), temps=("_found",))
