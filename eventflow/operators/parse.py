"""The parse step and its parsers: log formats in one text column to fields.

A parser turns a text column into a struct column that is NULL where the text does not fit.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text as js
from ..functions import regex as rx
from ..functions import text as tx
from .effect import Effect, once, operator, require

Parser = Callable[[Column, dict[str, Any]], Column]

# The line formats.
SYSLOG_LINE = r"^<(\d+)>(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(.+)$"
APACHE_LINE = r'^(\S+) \S+ \S+ \[([^\]]+)\] "([^"]*)" (\d+) (\S+)'
NGINX_LINE = r'^(\S+) - \S+ \[([^\]]+)\] "([^"]*)" (\d+) (\d+) "([^"]*)" "([^"]*)"'
CEF_LINE = r"^CEF:(\d+)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|(.*)$"
NUMBER_TEXT = r"\A[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\z"


def _line(value: Column, pattern: str, groups: int, build) -> Column:
    """Struct built from the captured groups, NULL without a match."""
    found = rx.captures(value, rx.compile_pattern(pattern), list(range(1, groups + 1)))
    return tx.let(found, lambda g: F.when(g.isNotNull(), build(lambda i: F.get(g, F.lit(i - 1)))))


def _int(value: Column, otherwise: int | None = None) -> Column:
    number = F.when(value.rlike(r"\A[+-]?\d+\z"), value.try_cast("bigint"))
    return number if otherwise is None else F.coalesce(number, F.lit(otherwise).cast("bigint"))


def parse_syslog(value: Column, settings: dict[str, Any]) -> Column:
    """RFC 3164: priority, facility, severity, timestamp, hostname, message, raw."""

    def build(g) -> Column:
        priority = _int(g(1))
        fields = F.struct(
            priority.alias("priority"),
            F.call_function("div", priority, F.lit(8)).alias("facility"),
            (priority % 8).alias("severity"),
            g(2).alias("timestamp"),
            g(3).alias("hostname"),
            g(4).alias("message"),
            value.alias("raw"),
        )
        return F.when(priority.isNotNull(), fields)

    return _line(value, SYSLOG_LINE, 4, build)


def parse_plaintext(value: Column, settings: dict[str, Any]) -> Column:
    """The whole text as message, with the current time."""
    return F.when(value.isNotNull(), F.struct(value.alias("message"), tx.rfc3339_now().alias("timestamp")))


def parse_apache(value: Column, settings: dict[str, Any]) -> Column:
    """Common access log; a size of ``-`` reads as 0."""
    line = tx.trim_space(value)

    def build(g) -> Column:
        return F.struct(
            g(1).alias("remote_addr"),
            g(2).alias("timestamp"),
            g(3).alias("request"),
            _int(g(4), 0).alias("status"),
            F.when(g(5) == "-", "0").otherwise(g(5)).alias("body_size"),
            F.lit("apache").alias("log_type"),
            line.alias("raw"),
            tx.rfc3339_now().alias("parsed_time"),
        )

    return _line(line, APACHE_LINE, 5, build)


def parse_nginx(value: Column, settings: dict[str, Any]) -> Column:
    """Combined access log with referer and user agent."""
    line = tx.trim_space(value)

    def build(g) -> Column:
        return F.struct(
            g(1).alias("remote_addr"),
            g(2).alias("timestamp"),
            g(3).alias("request"),
            _int(g(4), 0).alias("status"),
            _int(g(5), 0).alias("body_size"),
            g(6).alias("http_referer"),
            g(7).alias("http_user_agent"),
            F.lit("nginx").alias("log_type"),
            line.alias("raw"),
            tx.rfc3339_now().alias("parsed_time"),
        )

    return _line(line, NGINX_LINE, 7, build)


def _key_values(pieces: Column) -> Column:
    """Pairs of ``k=v`` pieces, untrimmed; pieces without ``=`` are left out."""
    cut = F.transform(pieces, lambda p: F.split(p, "=", 2))
    whole = F.filter(cut, lambda p: F.size(p) == 2)
    return F.transform(
        whole, lambda p: F.struct(F.get(p, F.lit(0)).alias("key"), F.get(p, F.lit(1)).alias("value"))
    )


def parse_influx(value: Column, settings: dict[str, Any]) -> Column:
    """Line protocol: measurement, tags map, fields map (number or text variants), timestamp."""
    line = tx.trim_space(value)

    def typed(p: Column) -> Column:
        number = F.when(p["value"].rlike(NUMBER_TEXT), p["value"].try_cast("double").cast("variant"))
        content = F.coalesce(number, F.btrim(p["value"], F.lit('"')).cast("variant"))
        return F.struct(p["key"].alias("key"), content.alias("value"))

    def build(parts: Column) -> Column:
        head = F.split(F.get(parts, F.lit(0)), ",")
        tags = _key_values(F.slice(head, F.lit(2), F.greatest(F.size(head) - 1, F.lit(0))))
        fields = F.transform(_key_values(F.split(F.get(parts, F.lit(1)), ",")), typed)
        fitting = F.struct(
            F.get(head, F.lit(0)).alias("measurement"),
            js.last_wins_map(tags, "key").alias("tags"),
            js.last_wins_map(fields, "key").alias("fields"),
            _int(F.get(parts, F.lit(2))).alias("timestamp"),
            F.lit("influx").alias("log_type"),
            line.alias("raw"),
            tx.rfc3339_now().alias("parsed_time"),
        )
        return F.when(F.size(parts) >= 2, fitting)

    return tx.let(F.split(line, r"(?U)\s+"), build)


def parse_cef(value: Column, settings: dict[str, Any]) -> Column:
    """Common Event Format: seven header fields and the extension pairs."""
    line = tx.trim_space(value)

    def build(g) -> Column:
        return F.struct(
            g(1).alias("cef_version"),
            g(2).alias("device_vendor"),
            g(3).alias("device_product"),
            g(4).alias("device_version"),
            g(5).alias("event_class_id"),
            g(6).alias("name"),
            _int(g(7), 0).alias("severity"),
            g(8).alias("extension"),
            F.lit("cef").alias("log_type"),
            line.alias("raw"),
            tx.rfc3339_now().alias("parsed_time"),
            F.when(g(8) != "", js.last_wins_map(_key_values(F.split(g(8), " ")), "key")).alias("extensions"),
        )

    return _line(line, CEF_LINE, 8, build)


def parse_raw(value: Column, settings: dict[str, Any]) -> Column:
    """The trimmed text, its byte length, and its JSON content if it is an object."""
    line = tx.trim_space(value)
    looks_json = line.startswith("{") & line.endswith("}")
    content = F.when(looks_json, js.strict_object(line))
    return tx.let(
        content,
        lambda json: F.when(
            value.isNotNull(),
            F.struct(
                line.alias("message"),
                F.lit("raw").alias("log_type"),
                line.alias("raw"),
                tx.rfc3339_now().alias("parsed_time"),
                F.octet_length(line).alias("line_length"),
                F.when(json.isNotNull(), "json").alias("detected_format"),
                json.alias("json_data"),
            ),
        ),
    )


def repaired_json(value: Column) -> Column:
    """VARIANT object of a text, after escaping raw line breaks and closing open braces if needed."""
    text = tx.trim_space(value)
    escaped = F.replace(F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    count = lambda c, mark: F.length(c) - F.length(F.replace(c, F.lit(mark)))

    def repair(line: Column) -> Column:
        missing = count(line, "{") - count(line, "}")
        closed = F.concat(line, F.repeat(F.lit("}"), F.greatest(missing, F.lit(0))))
        # Only a text that starts like an object can be repaired to one.
        return F.when(js.starts_object(line), F.coalesce(js.strict_object(line), js.strict_object(closed)))

    return F.coalesce(js.strict_object(value), tx.let(escaped, repair))


def parse_ndjson(value: Column, settings: dict[str, Any]) -> Column:
    """A JSON object, repaired if possible, else a ``malformed_ndjson`` record.

    With ``settings={"schema": "a int, b string"}`` the members become typed fields; otherwise
    they are in the ``record`` variant.
    """
    schema = settings.get("schema")

    def build(record: Column) -> Column:
        broken = record.isNull()
        extra = {
            "message": F.when(broken, value),
            "timestamp": F.when(broken, tx.rfc3339_now()),
            "_source": F.when(broken, F.lit("malformed_ndjson")),
        }
        if schema is None:
            members = [record.alias("record")]
        else:
            struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
            members = []
            for f in struct.fields:
                member = F.try_variant_get(record, "$[" + _json_key(f.name) + "]", f.dataType.simpleString())
                if f.name in extra:
                    member = F.coalesce(member, extra.pop(f.name))
                members.append(member.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*members, *[c.alias(n) for n, c in extra.items()]))

    return tx.let(repaired_json(value), build)


def _json_key(name: str) -> str:
    return '"' + name.replace("\\", "\\\\").replace('"', '\\"') + '"'


def parse_delimited(value: Column, settings: dict[str, Any]) -> Column:
    """One delimited line as named text fields (``headers``); another number of fields does not fit."""
    headers = settings.get("headers")
    require(bool(headers), "the csv / tsv parser needs settings.headers; read whole files with read_delimited")
    delimiter = settings.get("delimiter", ",")
    schema = ", ".join(f"`{h}` STRING" for h in headers)
    # A quoted field can hold the delimiter, so fields are counted outside quotes.
    bare = F.regexp_replace(value, '"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(delimiter))) + 1
    return F.when(fields == len(headers), F.from_csv(value, schema, {"sep": delimiter, "mode": "PERMISSIVE"}))


PARSERS: dict[str, Parser] = {
    "ndjson-logs": parse_ndjson,
    "syslog-rfc3164": parse_syslog,
    "plaintext": parse_plaintext,
    "ndjson": parse_ndjson,
    "csv": parse_delimited,
    "tsv": lambda value, settings: parse_delimited(value, {**settings, "delimiter": "\t"}),
    "apache": parse_apache,
    "nginx": parse_nginx,
    "influx": parse_influx,
    "cef": parse_cef,
    "raw": parse_raw,
}


def parse_any(value: Column, settings: dict[str, Any]) -> Column:
    """First parser that accepts the text: JSON object, repaired JSON object, syslog, plain text."""

    def build(record: Column, line: Column) -> Column:
        plain = record.isNull() & line.isNull()
        return F.when(
            value.isNotNull(),
            F.struct(
                F.when(record.isNotNull(), "ndjson").when(line.isNotNull(), "syslog").otherwise("plaintext").alias("parser"),
                record.alias("record"),
                *[line[n].alias(n) for n in ("priority", "facility", "severity", "hostname", "raw")],
                F.when(plain, value).otherwise(line["message"]).alias("message"),
                F.when(plain, tx.rfc3339_now()).otherwise(line["timestamp"]).alias("timestamp"),
            ),
        )

    def with_line(record: Column) -> Column:
        syslog = F.when(record.isNull(), parse_syslog(value, {}))
        return tx.let(syslog, lambda line: build(record, line))

    return tx.let(repaired_json(value), with_line)


@operator("parse")
def parse(
    df: DataFrame,
    parser_name: str | None = None,
    auto_select: bool = False,
    source_field: str = "message",
    target_field: str | None = None,
    on_parse_failure: str = "tag",
    preserve_raw: bool = False,
    settings: dict[str, Any] | None = None,
) -> Effect:
    """Parse a text field by name or by trial; a row that fails is tagged, skipped or passed through."""
    require(bool(parser_name) or auto_select, "parse needs 'parser_name' or 'auto_select'")
    require(not parser_name or parser_name in PARSERS, f"parser {parser_name!r} not found")
    skip, tag = on_parse_failure == "skip", on_parse_failure == "tag"

    def failed(reason: str) -> Effect:
        if skip:
            return Effect(df, keep=F.lit(False))
        return Effect(df, sets={"_parse_failure": F.lit(reason)} if tag else {}, applied=F.lit(tag))

    if not tx.has(df, source_field):
        return failed(f"source field '{source_field}' not found")
    source_type = tx.type_of(df, source_field)
    if not isinstance(source_type, (T.StringType, T.BinaryType)):
        return failed(f"source field '{source_field}' is not string or bytes")
    value = tx.field(source_field)
    if isinstance(source_type, T.BinaryType):
        value = F.decode(value, "UTF-8")
    parser = PARSERS[parser_name] if parser_name else parse_any
    prepared = once(once(df, "_in", value), "_out", parser(F.col("_in"), settings or {}))
    out = tx.field("_out")
    done = out.isNotNull()
    sets: dict[str, Column] = {}
    if target_field:
        same = tx.has(df, target_field) and tx.type_of(df, target_field) == tx.type_of(prepared, "_out")
        sets[target_field] = F.coalesce(out, tx.field(target_field)) if same else out
    else:
        for f in tx.type_of(prepared, "_out").fields:
            new = out.getField(f.name)
            if tx.has(df, f.name) and tx.type_of(df, f.name) == f.dataType:
                new = F.coalesce(new, tx.field(f.name))
            elif tx.has(df, f.name) and isinstance(tx.type_of(df, f.name), T.StringType):
                new = F.coalesce(tx.text(new, f.dataType), tx.field(f.name))
            sets[f.name] = new
    if preserve_raw:
        sets["_raw"] = F.when(done, tx.field("_in"))
    if tag:
        reason = F.when(tx.field("_in").isNull(), f"source field '{source_field}' not found").otherwise(
            f"line does not match {parser_name or 'any'} format"
        )
        # The tag of an earlier parse step stays.
        earlier = tx.field("_parse_failure") if tx.is_string(df, "_parse_failure") else F.lit(None).cast("string")
        sets["_parse_failure"] = F.coalesce(F.when(~done, reason), earlier)
    return Effect(
        prepared,
        sets=sets,
        keep=done if skip else None,
        applied=F.lit(True) if tag else done,
        temps=("_in", "_out"),
    )
