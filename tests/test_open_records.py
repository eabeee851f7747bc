"""Records with undeclared, mistyped or wholly undeclared fields: nothing is lost between reading and writing."""

import json

from pyspark.sql import functions as F

import eventflow as ef
from eventflow.sources.events import decode_lines
from eventflow.sources.sinks import event_line


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def written(df):
    return [json.loads(r[0]) for r in df.select(event_line(df).alias("line")).collect()]


def test_undeclared_and_mistyped_fields_survive(spark):
    df = decode_lines(lines(spark, '{"a":"x","b":1,"zz":5}', '{"a":3,"b":2}', '{"a":null}'), "a bigint, b bigint")
    assert written(df) == [{"a": "x", "b": 1, "zz": 5}, {"a": 3, "b": 2}, {}]
    assert [r[0] for r in df.select(F.map_keys("_mistyped")).collect()] == [["a"], None, None]


def test_chain_on_undeclared_records(spark):
    df = decode_lines(lines(spark, '{"b":1,"c":{"d":[1,2]},"e":"X y"}', '{"b":2,"e":"no"}', "junk"))
    chain = [
        {"type": "include", "config": {"field": "b", "equals": 1}},
        {"type": "mutate", "config": {"rename": {"c": "k"}}},
        {"type": "add_field", "config": {"field": "new", "value": "v"}},
    ]
    out = ef.run_pipeline(df.where("_error IS NULL"), chain)
    assert written(out) == [{"b": 1, "k": {"d": [1, 2]}, "e": "X y", "new": "v"}]
    flagged = ef.run_pipeline(df, [{"type": "mutate", "config": {"lowercase": ["e"]}, "condition": "b = 1"}])
    assert written(flagged.where("_error IS NULL")) == [{"b": 1, "c": {"d": [1, 2]}, "e": "x y"}, {"b": 2, "e": "no"}]


def test_plain_operator_looks_into_the_record(spark):
    df = decode_lines(lines(spark, '{"b":1}', '{"b":2}'))
    assert written(ef.include(df, field="b", equals=1)) == [{"b": 1}]
    assert written(ef.run_pipeline(df, None)) == [
        {"b": n, "processed_by": "eventflow", "pipeline_version": "default-1.0"} for n in (1, 2)
    ]


def test_removed_member_does_not_come_back(spark):
    df = decode_lines(lines(spark, '{"a":1,"secret":"x"}'), "a bigint")
    assert written(ef.remove_field(df, fields=["secret"])) == [{"a": 1}]


def test_flatten_spreads_everything(spark):
    df = spark.sql("SELECT named_struct('n', 1, 't', array('a','b','c')) AS u, map('x', array(1,2)) AS m, parse_json('{\"p\":{\"q\":[5]}}') AS v, 'z' AS s")
    assert written(ef.json_flatten(df)) == [
        {"u.n": 1, "u.t.0": "a", "u.t.1": "b", "u.t.2": "c", "m.x.0": 1, "m.x.1": 2, "v.p.q.0": 5, "s": "z"}
    ]
    longer = ef.json_flatten(spark.sql("SELECT array('a','b','c') AS t"), array_lengths={"t": 2})
    assert written(longer) == [{"t.0": "a", "t.1": "b", "t.2": "c"}]
    undeclared = decode_lines(lines(spark, '{"a":{"b":{"c":1}},"d":[{"e":2},3]}'))
    assert written(ef.run_pipeline(undeclared, [{"type": "json_flatten", "config": {}}])) == [{"a.b.c": 1, "d.0.e": 2, "d.1": 3}]


def test_upper_case_names_of_undeclared_members(spark):
    df = decode_lines(lines(spark, '{"a":{"b":"x:y","c":[{"d":1}]}}'))
    assert written(ef.run_pipeline(df, [{"type": "uppercase_keys", "config": {}}])) == [{"A": {"B": "x:y", "C": [{"D": 1}]}}]


def test_preview_and_audit_take_what_is_asked(spark):
    df = spark.range(1500).selectExpr("id", "cast(id AS string) AS m")
    chain = [{"type": "passthrough", "config": {}}] * 12
    assert ef.preview(df, chain[:1], "id", 1200).count() == 1200
    assert ef.run_pipeline_audited(df.limit(1), chain).count() == 1


def test_small_rates_are_kept(spark):
    df = spark.range(400_000)
    assert 5 <= ef.sample(df, percentage=0.005, key="id").count() <= 45
