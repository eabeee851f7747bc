"""One-row golden cases of every filter: config, input row, expected row (None: dropped)."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

import eventflow as ef

ANY = object()

CASES = [
    ("add_field", {"field": "new_field", "value": "test_value"}, "existing string", ("data",), {"existing": "data", "new_field": "test_value"}),
    ("add_field", {"field": "processed_at", "value": "${timestamp}"}, "message string", ("test",), {"message": "test", "processed_at": ANY}),
    ("remove_field", {"fields": ["unwanted"]}, "keep string, unwanted string", ("a", "b"), {"keep": "a"}),
    ("rename_field", {"from": "old_name", "to": "new_name"}, "old_name string, other string", ("v", "o"), {"new_name": "v", "other": "o"}),
    ("include", {"field": "host", "matches": r"\.108$"}, "host string, message string", ("192.168.1.108", "m"), {"host": "192.168.1.108", "message": "m"}),
    ("include", {"field": "host", "matches": r"\.108$"}, "host string, message string", ("192.168.1.109", "m"), None),
    ("exclude", {"field": "level", "matches": "^DEBUG$"}, "level string, message string", ("DEBUG", "m"), None),
    ("exclude", {"field": "level", "matches": "^DEBUG$"}, "level string, message string", ("INFO", "m"), {"level": "INFO", "message": "m"}),
    (
        "json_flatten",
        {"separator": "."},
        "user struct<name:string,address:struct<city:string,state:string>>, status string",
        (("John", ("NYC", "NY")), "active"),
        {"user.name": "John", "user.address.city": "NYC", "user.address.state": "NY", "status": "active"},
    ),
    ("drop", {"always_drop": True}, "message string", ("x",), None),
    ("mutate", {"uppercase": ["name"]}, "name string", ("john doe",), {"name": "JOHN DOE"}),
    ("mutate", {"lowercase": ["name"]}, "name string", ("JOHN DOE",), {"name": "john doe"}),
    (
        "regex_replace",
        {"pattern": r"\d{3}-\d{2}-\d{4}", "replacement": "XXX-XX-XXXX"},
        "message string",
        ("SSN: 123-45-6789",),
        {"message": "SSN: XXX-XX-XXXX"},
    ),
    (
        "kv",
        {"field_split": " ", "value_split": "=", "fields": ["user", "status", "level"]},
        "message string",
        ("user=john status=active level=5",),
        {"message": "user=john status=active level=5", "user": "john", "status": "active", "level": "5"},
    ),
    (
        "date_parse",
        {"format": "2006-01-02T15:04:05Z07:00", "target_field": "parsed_time"},
        "timestamp string",
        ("2025-11-24T12:00:00Z",),
        {"timestamp": "2025-11-24T12:00:00Z", "parsed_time": "2025-11-24T12:00:00Z"},
    ),
    (
        "fingerprint",
        {"source_fields": ["user", "action"], "method": "SHA256"},
        "user string, action string",
        ("john", "login"),
        {"user": "john", "action": "login", "fingerprint": hashlib.sha256(b"john|login").hexdigest()},
    ),
    ("sample", {"percentage": 100}, "message string", ("m",), {"message": "m"}),
    ("uppercase_keys", {}, "name string, status string", ("n", "s"), {"NAME": "n", "STATUS": "s"}),
    ("conditional", {"field": "status", "operator": "eq", "value": "error"}, "status string", ("error",), {"status": "error"}),
    ("conditional", {"field": "level", "operator": "eq", "value": "DEBUG", "action": "drop"}, "level string", ("DEBUG",), None),
    ("json_validate", {"fail_on_invalid": False}, "valid string, count bigint", ("yes", 1), {"valid": "yes", "count": 1}),
    ("passthrough", {}, "message string, level string", ("m", "INFO"), {"message": "m", "level": "INFO"}),
]


@pytest.mark.parametrize("kind,config,schema,values,expected", CASES, ids=[f"{i}-{c[0]}" for i, c in enumerate(CASES)])
def test_golden(spark, kind, config, schema, values, expected):
    df = spark.createDataFrame([values], schema)
    rows = [r.asDict(recursive=True) for r in ef.run_pipeline(df, [{"type": kind, "config": config}]).collect()]
    if expected is None:
        assert rows == []
        return
    assert len(rows) == 1
    shown = {k: (ANY if expected.get(k) is ANY and v else v) for k, v in rows[0].items()}
    assert shown == expected


def test_split_explodes(row):
    rows = row(ef.split, "id bigint, tags string", (1, "tag1, tag2,tag3"), (2, "one"), (3, None), field="tags", terminator=",")
    assert [(r["id"], r["tags"]) for r in rows] == [(1, "tag1"), (1, "tag2"), (1, "tag3"), (2, "one"), (3, None)]


def test_split_array_keeps_short_rows(row):
    rows = row(ef.split, "id bigint, a array<string>", (1, ["x", "y"]), (2, []), (3, None), (4, ["z"]), field="a")
    assert [(r["id"], r["a"]) for r in rows] == [(1, "x"), (1, "y"), (2, None), (3, None), (4, "z")]


def test_chain(spark):
    df = spark.createDataFrame([("192.168.1.108", (50, 80)), ("192.168.1.1", (1, 2))], "host string, data struct<cpu:bigint,mem:bigint>")
    spec = [
        {"type": "include", "config": {"field": "host", "matches": r"\.108$"}},
        {"type": "add_field", "config": {"field": "processed", "value": "true"}},
        {"type": "json_flatten", "config": {"separator": "."}},
    ]
    assert [r.asDict() for r in ef.run_pipeline(df, spec).collect()] == [
        {"host": "192.168.1.108", "data.cpu": 50, "data.mem": 80, "processed": "true"}
    ]


def test_flatten_arrays_of_record(row):
    schema = "timestamp string, data struct<user:struct<name:string,age:double>,tags:array<string>>, ev struct<OPEN:double>"
    rows = row(ef.json_flatten, schema, ("t", (("n", 30.0), ["a", "b"]), (1.0,)), array_lengths={"data.tags": 2})
    shown = [{k: v for k, v in r.items() if not k.startswith("_")} for r in rows]
    assert shown == [
        {"timestamp": "t", "data.user.name": "n", "data.user.age": 30.0, "data.tags.0": "a", "data.tags.1": "b", "ev.OPEN": 1.0}
    ]
    assert rows[0]["_rest"] == {}


def test_flatten_field(spark):
    texts = [
        '{"a":1,"b":{"c":[1,{"d":"x"},[1,2]],"e":null},"f":{},"g":[],"s":"{\\"q\\":1}"}',
        "[1,2]",
        "nope",
        "5",
        '{"a":1} x',
        '{"a.b":1,"a":{"b":2}}',
        '{"a":{"b":{"c":{"d":{"e":[{"f":{"g":1}}]}}}}}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    out = ef.json_flatten(df, source_field="s").select("i", F.to_json("`@flatten`").alias("j")).orderBy("i")
    assert [r.j and json.loads(r.j) for r in out.collect()] == [
        {"a": 1, "b.c.0": 1, "b.c.1.d": "x", "b.c.2": [1, 2], "b.e": None, "s": '{"q":1}'},
        {"value": [1, 2]},
        None,
        {"value": 5},
        None,
        {"a.b": 2},
        {"a.b.c.d.e.0.f.g": 1},
    ]


@pytest.mark.parametrize("field,keys", [("metadata", {"METADATA": False}), (["metadata", "context"], {}), ("*", {}), ([], {})])
def test_uppercase_keys(spark, field, keys):
    schema = "metadata struct<user_name:string,user_id:bigint>, context struct<app_name:string>, message string"
    df = spark.createDataFrame([(("u", 1), ("a",), "m")], schema)
    row = ef.uppercase_keys(df, source_field=field).collect()[0].asDict(recursive=True)
    upper = {"USER_NAME": "u", "USER_ID": 1}
    if field in ("*", []):
        assert row == {"METADATA": upper, "CONTEXT": {"APP_NAME": "a"}, "MESSAGE": "m"}
    else:
        assert row["metadata"] == upper and row["message"] == "m"
        assert list(row["context"]) == (["APP_NAME"] if "context" in field else ["app_name"])


@pytest.mark.parametrize(
    "config,expected",
    [
        ({"pattern": r"\d+", "replacement": "X"}, "Error code X at line X"),
        ({"pattern": r"\d+", "replacement": "X", "global": False}, "Error code X at line 123"),
        ({"pattern": r"(\d)(\d*)", "replacement": "<$2$1>"}, "Error code <044> at line <231>"),
        ({"pattern": r"(?P<a_b>\d)\d*", "replacement": "${a_b}0$a_bx$9$$"}, "Error code 40$ at line 10$"),
        ({"pattern": r"\d+", "replacement": "$0\\", "global": False}, "Error code $0\\ at line 123"),
    ],
)
def test_regex_replace(row, config, expected):
    assert row(ef.regex_replace, "message string", ("Error code 404 at line 123",), **config)[0]["message"] == expected


def test_regex_replace_target_and_errors(row, spark):
    rows = row(ef.regex_replace, "raw string", ("Hello! @World#123$",), (None,), source_field="raw", target_field="clean", pattern="[^a-zA-Z0-9 ]")
    assert [r["clean"] for r in rows] == ["Hello World123", None]
    for pattern in ("[unclosed", "(a", "a)", "*a", r"(a)\1", "(?=a)", "a\\"):
        with pytest.raises(ValueError):
            ef.regex_replace(spark.range(1), pattern=pattern)


def test_sampling(spark):
    df = spark.range(1000).selectExpr("cast(id AS string) AS message")
    half = ef.sample(df, percentage=50, seed=3)
    assert 400 <= half.count() <= 600
    assert {r.message for r in half.collect()} == {r.message for r in ef.sample(df, rate=0.5, seed=3).collect()}
    assert ef.sample(df, percentage=0).count() == 0 and ef.sample(df, rate=1.0).count() == 1000
    keyed = {r.message for r in ef.sample(df, percentage=30, key="message").collect()}
    assert keyed == {r.message for r in ef.sample(df.repartition(7), percentage=30, key="message").collect()}
    for bad in ({"percentage": 101}, {"percentage": -1}, {"rate": 1.5}, {}):
        with pytest.raises(ValueError):
            ef.sample(df, **bad)
