"""Predicates and sampling."""

from pyspark.sql import functions as F

import eventflow as ef

from .base import query, table

KEPT = "SELECT event_id, event_type FROM events WHERE "


def _kept(df):
    return df.select("event_id", "event_type")


@query("include_equals", KEPT + "event_type = 'error' OR event_type LIKE '%lic%' OR regexp_matches(event_type, '^v.*w$')")
def _(spark, sf):
    return _kept(ef.include(table(spark, sf, "events"), field="event_type", equals="error", contains="lic", matches="^v.*w$"))


@query("include_number", KEPT + "user_id = 8")
def _(spark, sf):
    # contains and matches look at strings only, so they never match a number.
    return _kept(ef.include(table(spark, sf, "events"), field="user_id", equals=8, contains="1", matches="1"))


@query(
    "include_any_field",
    """SELECT doc_id FROM documents WHERE lang = 'en' OR source = 'en'
       OR regexp_matches(lang, '^[a-d]') OR regexp_matches(source, '^[a-d]')""",
)
def _(spark, sf):
    out = ef.include(
        table(spark, sf, "documents"), any_field=["lang", "source", "absent"], any_equals="en", any_matches="^[a-d]"
    )
    return out.select("doc_id")


@query("exclude_missing", KEPT + "event_type IS DISTINCT FROM 'error' AND NOT (event_type LIKE '%view%')")
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("kind", F.when(F.col("event_type") != "click", F.col("event_type")))
    return _kept(ef.exclude(df, field="kind", equals="error", matches="view"))


@query("drop_if", KEPT + "NOT (event_type = 'error' AND user_id <> 8)")
def _(spark, sf):
    return _kept(
        ef.drop(table(spark, sf, "events"), if_field="event_type", equals="error", unless_field="user_id", unless_equals=8)
    )


@query("drop_not_equals", KEPT + "event_type IN ('click', 'signup') OR event_type = 'view'")
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("kind", F.when(F.col("event_type") != "view", F.col("event_type")))
    return _kept(ef.drop(ef.drop(df, if_field="kind", matches="^(error|purchase)$"), if_field="kind", not_equals="click", unless_field="kind", unless_matches="^sign"))


@query("drop_unless", KEPT + "event_type = 'error'")
def _(spark, sf):
    return _kept(ef.drop(table(spark, sf, "events"), unless_field="event_type", unless_equals="error"))


@query("drop_always", KEPT + "FALSE")
def _(spark, sf):
    return _kept(ef.drop(table(spark, sf, "events"), always_drop=True))


def bucket(key: str) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 15))::BIGINT"


def cut(rate: float) -> int:
    return round(rate * 2**60)


@query("drop_percentage_keyed", KEPT + f"NOT (event_type = 'view' AND {bucket('event_id')} < {cut(0.3)})")
def _(spark, sf):
    return _kept(ef.drop(table(spark, sf, "events"), if_field="event_type", equals="view", percentage=30, key="event_id"))


def _within(df, total, low, high):
    """Whether a random choice kept a plausible share, and that it kept whole rows only once."""
    none = F.lit(0).cast("bigint")
    kept = df.agg(F.count("*").alias("kept"), F.countDistinct("event_id").alias("ids"), none.alias("total"))
    every = total.agg(none.alias("kept"), none.alias("ids"), F.count("*").alias("total"))
    sums = kept.unionByName(every).agg(*[F.sum(c).alias(c) for c in ("kept", "ids", "total")])
    share = F.col("kept") / F.col("total")
    return sums.select("total", share.between(low, high).alias("within"), (F.col("kept") == F.col("ids")).alias("once"))


@query("drop_percentage", "SELECT count(*) AS total, TRUE AS within, TRUE AS once FROM events")
def _(spark, sf):
    df = table(spark, sf, "events")
    return _within(ef.drop(df, percentage=50, seed=7), df, 0.4, 0.6)


@query("drop_percentage_small", KEPT + f"NOT ({bucket('event_id')} < {cut(0.00005)})")
def _(spark, sf):
    return _kept(ef.drop(table(spark, sf, "events"), percentage=0.005, key="event_id"))


@query("conditional_eq", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey <> 370")
def _(spark, sf):
    df = ef.conditional(table(spark, sf, "orders"), field="o_orderstatus", operator="eq", value="F")
    return ef.conditional(df, field="o_custkey", operator="eq", value="370", action="drop").select("o_orderkey")


@query("conditional_ne_missing", KEPT + "event_type IN ('view', 'click') OR event_type NOT LIKE '%u%' AND event_type <> 'error'")
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("kind", F.when(F.col("event_type") != "view", F.col("event_type")))
    df = ef.conditional(df, field="kind", operator="ne", value="error")
    df = ef.conditional(df, field="absent", operator="ne", value="x")
    return _kept(ef.conditional(df, field="kind", operator="not_contains", value="u"))


@query("conditional_range", "SELECT event_id, value FROM events WHERE value >= 100 AND value < 200.5 AND NOT user_id > 100")
def _(spark, sf):
    df = ef.conditional(table(spark, sf, "events"), field="value", operator="gte", value=100)
    df = ef.conditional(df, field="value", operator="lt", value="200.5")
    return ef.conditional(df, field="user_id", operator="gt", value=100, action="drop").select("event_id", "value")


@query("conditional_exists", KEPT + "event_type <> 'view' AND CAST(user_id AS VARCHAR) LIKE '%7%'")
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("kind", F.when(F.col("event_type") != "view", F.col("event_type")))
    df = ef.conditional(df, field="kind", operator="exists")
    df = ef.conditional(df, field="absent", operator="not_exists")
    return _kept(ef.conditional(df, field="user_id", operator="contains", value=7))


@query(
    "conditional_field_edit",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_name LIKE 'Customer#00000000%' THEN 'masked' ELSE c_name END AS c_name,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_nationkey >= 20 THEN -1 ELSE CAST(c_nationkey AS BIGINT) END AS c_nationkey FROM customer""",
)
def _(spark, sf):
    df = table(spark, sf, "customer")
    df = ef.conditional_field(df, field="c_mktsegment", operator="equals", value="BUILDING")
    df = ef.conditional_field(
        df, field="c_name", operator="starts_with", value="Customer#00000000", action="replace", replace_with="masked"
    )
    df = ef.conditional_field(df, field="c_acctbal", operator="lt", value=0, action="set_null")
    df = ef.conditional_field(df, field="c_nationkey", operator="gte", value=20, action="replace", replace_with=-1)
    return df.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))


@query(
    "conditional_field_rows",
    KEPT + "(event_type = 'view' OR regexp_matches(event_type, 'r')) AND event_type NOT LIKE '%chase'",
)
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("kind", F.when(F.col("event_type") != "view", F.col("event_type")))
    df = ef.conditional_field(df, field="kind", operator="matches", value="r", action="keep_record")
    df = ef.conditional_field(df, field="kind", operator="ends_with", value="chase", action="drop_record")
    # A number operator with a text value never holds.
    return _kept(ef.conditional_field(df, field="user_id", operator="gt", value="1", action="drop_record"))


@query("json_validate", "SELECT event_id FROM events WHERE event_id % 5 NOT IN (1, 2, 4)")
def _(spark, sf):
    df = table(spark, sf, "events").withColumn(
        "message",
        F.expr(
            """CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN substr(props, 1, length(props) - 1)
               WHEN 2 THEN concat(props, ' x') WHEN 3 THEN cast(user_id AS string) END"""
        ),
    )
    return ef.json_validate(df).select("event_id")


@query("json_validate_lenient", "SELECT event_id FROM events")
def _(spark, sf):
    return ef.json_validate(table(spark, sf, "events"), source_field="event_type", fail_on_invalid=False).select("event_id")


@query("sample_rate", "SELECT count(*) AS total, TRUE AS within, TRUE AS once FROM events")
def _(spark, sf):
    df = table(spark, sf, "events")
    return _within(ef.sample(df, rate=0.5, seed=11), df, 0.4, 0.6)


@query("sample_keyed_small", KEPT + f"{bucket('event_id')} < {cut(0.0005)}")
def _(spark, sf):
    return _kept(ef.sample(table(spark, sf, "events"), rate=0.0005, key="event_id"))


@query("sample_bounds", KEPT + "event_type = 'error'")
def _(spark, sf):
    df = table(spark, sf, "events")
    all_errors = ef.sample(df.where("event_type = 'error'"), percentage=100)
    nothing = ef.sample(df.where("event_type <> 'error'"), rate=0.0)
    return _kept(all_errors.unionByName(nothing))


@query("sample_keyed", KEPT + f"{bucket('event_id')} < {cut(0.25)}")
def _(spark, sf):
    return _kept(ef.sample(table(spark, sf, "events"), percentage=25, key="event_id"))
