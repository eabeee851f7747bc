"""Value rules, parsers, look-ups and specifications, edge by edge."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

import eventflow as ef
from eventflow.functions import dates as dt
from eventflow.functions import net
from eventflow.functions import regex as rx
from eventflow.functions import text as tx
from eventflow.operators.enrich import lookup_join
from eventflow.operators.grok_patterns import PATTERNS, expand
from eventflow.operators.predicates import matcher


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def test_trim_strips_unicode_space(spark):
    assert column(spark, ["\u00a0\t x \u3000\n", "\u2003", "a b"], tx.trim_space) == ["x", "", "a b"]


def test_text_of_numbers(spark):
    kind = spark.createDataFrame([(1.5,)], "v double").schema["v"].dataType
    assert column(spark, [7.0, 6.55, 1e7, -3.0], lambda c: tx.text(c, kind), "double") == ["7", "6.55", "10000000", "-3"]


def test_missing_fields_in_predicates(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, f string")
    ids = lambda out: sorted(r.id for r in out.collect())
    assert ids(ef.conditional(df, field="f", operator="ne", value="x")) == [1]
    assert ids(ef.conditional(df, field="f", operator="not_contains", value="x")) == [1]
    assert ids(ef.exclude(df, field="f", equals="x")) == [1]
    assert ids(ef.exclude(df, field="gone", equals="x")) == [1, 2]
    assert ids(ef.include(df, field="gone", equals="x")) == []
    assert ids(ef.include(df, field="f")) == []
    assert ids(ef.drop(df, if_field="f", not_equals="y")) == [1]
    assert ids(ef.conditional_field(df, field="f", operator="equals", value="y", action="keep_record")) == [1]
    assert ids(ef.conditional_field(df, field="f", operator="not_exists", action="drop_record")) == [2]
    assert [r.f for r in ef.conditional_field(df, field="f", operator="exists").collect()] == [None, None]
    assert ids(ef.json_validate(df, source_field="f")) == []
    assert df.select(matcher(df, field="id", equals="2").found.alias("m")).collect()[1].m is True


@pytest.mark.parametrize(
    "source,text,matched",
    [
        (r"a.b", "a\u2028b", True),
        (r"a.b", "a\nb", False),
        (r"b$", "b\n", False),
        (r"(?m)a$", "a\nb", True),
        (r"[[:alpha:]]+[]x]", "abc]", True),
        (r"[a[]", "[", True),
        (r"x{,2}", "x{,2}", True),
        (r'{"k"', '{"k"', True),
        (r"[a&&b]", "&", True),
        (r"\Qa.b\E+", "a.bb", True),
        (r"(?i)é", "É", True),
        (r"\p{Greek}", "α", True),
        (r"\v", "\x0b", True),
    ],
)
def test_regex_dialect(spark, source, text, matched):
    assert column(spark, [text], lambda c: rx.matches(c, source)) == [matched]


def test_captures_equal_python(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab=1 \n\x01\x02") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    pattern = rx.compile_pattern(r"(a+)(b)?=(?P<n>[0-9]*)")
    got = column(spark, texts, lambda c: rx.captures(c, pattern, [1, 2, 3]))
    for text, groups in zip(texts, got):
        match = re.search(r"(a+)(b)?=([0-9]*)", text)
        assert groups == ([g or "" for g in match.groups()] if match else None)


SAMPLES = {
    "USER": "bob.x", "EMAILADDRESS": "a+b@c.example", "BASE16NUM": "0x1F", "QUOTEDSTRING": '"a \\" b"',
    "UUID": "123e4567-e89b-12d3-a456-426614174000", "MAC": "0011.2233.4455", "WINDOWSMAC": "00-11-22-33-44-55",
    "COMMONMAC": "00:11:22:33:44:55", "IPV6": "1:2:3:4:5:6:7:8", "IP": "10.0.0.1", "HOSTNAME": "h-1.example", "PATH": "/a/b",
    "UNIXPATH": "/a/b.c", "TTY": "/dev/pts/3", "WINPATH": "C:\\a\\b", "URIHOST": "h.example:80", "URIPATHPARAM": "/a/b?x=1&y=[2]",
    "URI": "http://h.example/a?b=c", "DAY": "Tuesday", "TIMESTAMP_ISO8601": "2025-01-02T03:04:05.678+01:00", "DATE_US": "12/31/2024",
    "DATE_EU": "31.12.2024", "DATESTAMP_RFC822": "Mon Jan 2 2006", "DATESTAMP_RFC2822": "Mon, 2 Jan 2006 15:04:05 +07:00",
    "DATESTAMP_OTHER": "Mon Jan 2 15:04:05 PST 2006", "DATESTAMP_EVENTLOG": "20060102150405", "SYSLOGTIMESTAMP": "Jan  2 15:04:05",
    "SYSLOGFACILITY": "<13.4>", "HTTPDATE": "01/Nov/2025:10:15:30 +0000", "LOGLEVEL": "WARNING", "HTTPMETHOD": "PATCH",
    "HTTPVERSION": "HTTP/1.1", "EVENT_TIMESTAMP": "2025-01-02T03:04:05.678Z", "EVENT_LOGLEVEL": "FATAL",
    "EVENT_UUID": "123e4567-e89b-12d3-a456-426614174000", "SYSLOGPROG": "cron[12]",
}


def test_every_builtin_pattern_compiles_and_matches(spark):
    assert len(PATTERNS) == 69
    columns = [
        F.regexp_extract(F.lit(SAMPLES.get(name, "")), rx.compile_pattern("^(" + expand("%{" + name + "}") + ")$").java, 1).alias(name)
        for name in PATTERNS
    ]
    row = spark.range(1).select(columns).first().asDict()
    assert {n: row[n] for n in SAMPLES} == SAMPLES


def test_grok_combined_log_and_long_quotes(row):
    line = '192.168.1.100 - - [01/Nov/2025:10:15:30 +0000] "GET /api/users HTTP/1.1" 200 1234 "-" "' + "Moz" * 20000 + '"'
    out = row(ef.grok, "message string", (line,), pattern="%{COMBINEDAPACHELOG}")[0]
    assert (out["client"], out["method"], out["status"], out["referrer"]) == ("192.168.1.100", "GET", "200", '"-"')
    assert len(out["agent"]) == 60002 and out["http_version"] == "1.1"


def test_grok_unknown_name_circle_and_target_merge(row, spark):
    out = row(ef.grok, "message string, t struct<a:string,b:string>", ("x 12", ("old", "keep")), pattern="%{NOPE:a} %{INT:n}", target_field="t", overwrite_keys=False)
    assert out[0]["t"] == {"a": "old", "b": "keep", "n": "12"}
    with pytest.raises(ValueError):
        ef.grok(spark.createDataFrame([("x",)], "message string"), pattern="%{A}", custom_patterns={"A": "%{B}", "B": "%{A}"})


def test_kv_edges(row):
    text = "a=1 b= a=3 =x c d==2"
    assert row(ef.kv, "message string", (text,), ("none",), (None,))[0]["kv"] == {"a": "3", "b": "", "d": "=2"}
    assert row(ef.kv, "message string", (text,), allow_duplicate=False, target_field="t")[0]["t"]["a"] == "1"
    rows = row(ef.kv, "message string", (text,), ("none",), default_values={"z": "9"}, remove_field=True)
    assert rows[0]["kv"]["z"] == "9" and rows[0]["message"] is None and rows[1] == {"message": "none", "kv": None}


def test_mutate_convert_edges(spark):
    df = spark.createDataFrame([("5",), (" 5",), ("+7",), ("1.5",), ("yes",), ("t",), ("1d",)], "s string")
    out = ef.mutate(df.selectExpr("s AS i", "s AS f", "s AS b"), convert={"i": "int", "f": "float", "b": "bool"}).collect()
    assert [r.i for r in out] == [5, None, 7, None, None, None, None]
    assert [r.f for r in out] == [5.0, None, 7.0, 1.5, None, None, None]
    assert [r.b for r in out] == [None, None, None, None, None, True, None]
    with pytest.raises(ValueError):
        ef.mutate(df, convert={"s": "date"})


@pytest.mark.parametrize(
    "layout,text,zone,expected",
    [
        ("2006-01-02 15:04:05", "2024-07-01 12:00:00", "Europe/Berlin", "2024-07-01T12:00:00+02:00"),
        ("2006-01-02T15:04:05Z07:00", "2024-01-01T00:00:00.999+05:30", "UTC", "2023-12-31T18:30:00Z"),
        ("2006-01-02 15:04:05,000", "2024-01-01 00:00:00,123", "UTC", "2024-01-01T00:00:00Z"),
        ("Mon Jan _2 15:04:05 2006", "Tue Feb  6 01:02:03 2024", "UTC", "2024-02-06T01:02:03Z"),
        ("Mon, 02 Jan 2006 15:04:05 MST", "Tue, 06 Feb 2024 01:02:03 GMT", "UTC", "2024-02-06T01:02:03Z"),
        ("02/01/06 03:04 PM", "31/12/75 12:15 AM", "UTC", "1975-12-31T00:15:00Z"),
        ("2006-01-02", "2024-02-30", "UTC", None),
        ("2006-01-02", "2024-2-3", "UTC", None),
        ("2006-01-02", "2024-02-03 ", "UTC", None),
    ],
)
def test_layouts(spark, layout, text, zone, expected):
    assert column(spark, [text], lambda c: dt.rfc3339(dt.parse_layout(c, layout, zone), zone)) == [expected]


def test_epochs(row):
    values = [(str(v),) for v in (0, 1698840930, 10**12, 1698840930123, 1698840930123456, 1698840930123456789, -1)]
    rows = row(ef.date_parse, "timestamp string", *values, formats=["unix", "unix_ms"])
    day = "2023-11-01T12:15:30Z"
    assert [r["@timestamp"] for r in rows] == ["1970-01-01T00:00:00Z", day, "+33658-09-27T01:46:40Z", day, day, day, None]
    rows = row(ef.date_parse, "timestamp string", ("-1500",), formats=["unix_ms"])
    assert rows[0]["@timestamp"] == "1969-12-31T23:59:58Z"


def test_addresses_equal_python(spark):
    import ipaddress

    texts = ["1.2.3.4", "01.2.3.4", "256.1.1.1", "::1", "2001:db8::1", "::ffff:1.2.3.4", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "::",
             "1::2::3", "fe80::1%eth0", ":1:2", "1:2:3:4:5:6:7::", "x", "", "1:2:3:4:5:6:7:8:9", "12345::", "1.2.3", "::1.2.3.999"]

    def expected(text):
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            return None
        if address.version == 4:
            return net.V4_PREFIX + f"{int(address):08x}"
        return f"{int(address):032x}" if "%" not in text else None

    assert column(spark, texts, net.ip_hex) == [expected(t) for t in texts]


def test_geoip_wide_and_narrow_ranges(spark):
    ranges = spark.createDataFrame(
        [("1.2.0.0", "1.2.255.255", "A"), ("10.0.0.0", "20.255.255.255", "B"), ("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", "C"), ("2a00::", "2aff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "D")],
        "start_ip string, end_ip string, country_name string",
    )
    ips = {"1.2.3.4": "A", "::ffff:1.2.3.4": "A", "15.0.0.1": "B", "2001:db8::9": "C", "2a01::5": "D", "9.9.9.9": None, "bad": None, None: None}
    df = spark.createDataFrame([(i,) for i in ips], "ip_address string")
    for broadcast in (None, True, False):
        out = ef.geoip(df, fields=["country"], tables={"geoip": ranges}, broadcast=broadcast)
        assert {r.ip_address: r.geoip and r.geoip.country for r in out.collect()} == ips


def test_shuffle_lookup_with_hot_and_missing_keys(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 50) END AS k")
    lookup = spark.createDataFrame([("hot", 1, "H"), ("k5", 2, "five"), ("k8", 1, "late")], "_key string, n int, v string")
    unique = lookup.select("_key", F.struct("v").alias("_row"))
    results = [
        sorted((r.id, r._found and r._found.v) for r in lookup_join(df.repartition(5), F.col("k"), unique, small).collect())
        for small in (True, False)
    ]
    assert results[0] == results[1] and len(results[0]) == 3000
    assert results[1][0] == (0, "H") and results[1][1] == (1, None)


def test_parse_failure_policies(row, spark):
    lines = [("<34>Oct 11 22:14:15 host msg",), ("zzz",), (None,)]
    tagged = row(ef.parse, "message string", *lines, parser_name="syslog-rfc3164")
    assert [bool(r["_parse_failure"]) for r in tagged] == [False, True, True]
    assert [r["message"] for r in tagged] == ["msg", "zzz", None] and tagged[0]["facility"] == 4
    assert len(row(ef.parse, "message string", *lines, parser_name="syslog-rfc3164", on_parse_failure="skip")) == 1
    assert "_parse_failure" not in row(ef.parse, "message string", *lines, parser_name="cef", on_parse_failure="pass_through")[0]
    assert row(ef.parse, "other string", ("x",), parser_name="raw")[0]["_parse_failure"] == "source field 'message' not found"
    with pytest.raises(ValueError):
        ef.parse(spark.createDataFrame([("x",)], "message string"), parser_name="sflow")


def test_failure_tag_of_earlier_step_stays(spark):
    df = spark.createDataFrame([("x",)], "message string")
    both = ef.parse(ef.parse(df, parser_name="cef"), parser_name="plaintext")
    assert both.first()._parse_failure == "line does not match cef format"


def test_preview_takes_the_first_rows(spark):
    out = ef.preview(spark.range(50).selectExpr("id", "cast(id AS string) AS m"), [{"type": "exclude", "config": {"field": "m", "equals": "1"}}], "id", 3)
    assert sorted((r._input, r._skipped) for r in out.collect()) == [
        ('{"id":0,"m":"0"}', False), ('{"id":1,"m":"1"}', True), ('{"id":2,"m":"2"}', False)]


def test_apache_dash_size_and_ndjson(row):
    line = '1.1.1.1 - - [x] "GET / HTTP/1.1" 404 -'
    assert row(ef.parse, "message string", (line,), parser_name="apache")[0]["body_size"] == "0"
    settings = {"schema": "a string, timestamp string"}
    rows = row(ef.parse, "message string", ('{"a":{"b":1}',), ('{"a":"x\ty"}',), ("junk",), ('{"a":1} x',), parser_name="ndjson", settings=settings, target_field="o")
    assert [r["o"]["a"] for r in rows] == ['{"b":1}', "x\ty", None, None]
    assert [r["o"]["_source"] for r in rows] == [None, None, "malformed_ndjson", "malformed_ndjson"]


def test_spec_validation(spark):
    df = spark.createDataFrame([("x", 1)], "message string, n int")
    spec = [
        {"type": "nope", "config": {}},
        {"type": "grok", "config": {}},
        {"type": "include", "config": {"field": "message", "matches": "("}},
        {"type": "sample", "config": {"rate": 2}},
        {"type": "add_field", "config": {"field": "a"}},
        {"type": "enricher", "config": {"enricher_id": "x", "source_field": "n"}},
        {"type": "include", "config": {"field": "message", "equals": "x"}},
        {"type": "nope", "config": {}, "enabled": False},
    ]
    assert [p.split(" ")[1] for p in ef.validate_spec(spec, df)] == ["0", "1", "2", "3", "4", "5"]
    with pytest.raises(ValueError):
        ef.run_pipeline_audited(df, [{"type": "passthrough"}] * 11, max_filters=10)
    with pytest.warns(UserWarning):
        ef.run_pipeline(df, [{"type": "date_parse", "config": {"source_field": "message", "locale": "en"}}])


def test_audit_keeps_output_of_skipped_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    spec = [
        {"type": "rename_field", "config": {"from": "k", "to": "key"}},
        {"type": "exclude", "config": {"field": "key", "equals": "a"}},
        {"type": "remove_field", "config": {"field": "key"}},
        {"type": "mutate", "config": {"convert": {"id": "string"}}},
    ]
    rows = {r._input: r for r in ef.run_pipeline_audited(df, spec).collect()}
    first, second = rows['{"id":1,"k":"a"}'], rows['{"id":2,"k":"b"}']
    assert (first._output, first._skipped_by, first._applied) == ('{"id":1,"key":"a"}', "exclude", ["rename_field", "exclude"])
    assert (second._output, second._applied) == ('{"id":"2"}', ["rename_field", "remove_field", "mutate"])


def test_merge_and_interpolate(row):
    out = row(ef.mutate, "a array<string>, b array<string>, c string", (["x"], None, "y"), merge=[{"source": "b", "target": "a"}, {"source": "c", "target": "a"}])
    assert out[0]["a"] == ["x", "y"]
    out = row(ef.add_field, "m string", ("x",), field="f", value="${tenant_id}-${nope}-${line_number}${", tenant_id="T")
    assert out[0]["f"] == "T-${nope}-0${"
