"""Field edits and the mutate operations."""

from pyspark.sql import functions as F

import eventflow as ef

from .base import EVENTS, events, query, table


@query(
    "add_field",
    f"SELECT event_id, tenant_id || '/' || dataset_id || '#' || event_id || ' ${{other}} x' AS origin FROM {EVENTS}",
)
def _(spark, sf):
    out = ef.add_field(
        events(spark, sf),
        field="origin",
        value="${tenant_id}/${dataset_id}#${line_number} ${other} ${mine}",
        line_number="event_id",
        variables={"mine": "x"},
    )
    return out.select("event_id", "origin")


@query("remove_field", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    return ef.remove_field(table(spark, sf, "events"), field="ts", fields=["props", "absent"])


@query(
    "rename_field",
    """SELECT o_orderkey, o_orderpriority AS priority,
       CASE WHEN o_orderstatus = 'F' THEN 'final' ELSE 'kept' END AS state FROM orders""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", "final").alias("note"),
        F.lit("kept").alias("state"),
    )
    df = ef.rename_field(df, **{"from": "o_orderpriority", "to": "priority"})
    return ef.rename_field(df, **{"from": "note", "to": "state"})


MAIL = r"([A-Za-z0-9._%+-]+)@([A-Za-z0-9.-]+\.[A-Za-z]{2,})"


@query(
    "regex_replace_all",
    f"SELECT doc_id, regexp_replace(text, '{MAIL}', '\\2 at <\\1>$', 'g') AS clean FROM documents",
)
def _(spark, sf):
    out = ef.regex_replace(
        table(spark, sf, "documents"), source_field="text", target_field="clean", pattern=MAIL, replacement="$2 at <${1}>$$${none}"
    )
    return out.select("doc_id", "clean")


@query(
    "regex_replace_first",
    r"SELECT doc_id, regexp_replace(text, '[0-9]{4,}', '$1#') AS text FROM documents",
)
def _(spark, sf):
    out = ef.regex_replace(
        table(spark, sf, "documents"), source_field="text", pattern="[0-9]{4,}", replacement="$1#", **{"global": False}
    )
    return out.select("doc_id", "text")


@query(
    "uppercase_keys",
    """SELECT c_custkey AS "C_CUSTKEY", c_name AS name, c_mktsegment AS segment,
       CAST(c_nationkey AS BIGINT) AS nation FROM customer""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey",
        F.struct(
            "c_name",
            F.struct(F.col("c_mktsegment").alias("segment"), F.array(F.struct("c_nationkey")).alias("places")).alias("more"),
        ).alias("info"),
    )
    out = ef.uppercase_keys(df)
    return out.select(
        "C_CUSTKEY",
        F.col("INFO.C_NAME").alias("name"),
        F.col("INFO.MORE.SEGMENT").alias("segment"),
        F.col("INFO.MORE.PLACES")[0]["C_NATIONKEY"].cast("bigint").alias("nation"),
    )


@query(
    "uppercase_keys_map",
    """SELECT c_custkey, c_name AS name, c_mktsegment AS segment FROM customer""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").withColumn(
        "info", F.create_map(F.lit("name"), "c_name", F.lit("segment"), "c_mktsegment")
    )
    out = ef.uppercase_keys(df, source_field=["info", "c_name", "absent"])
    return out.select("c_custkey", F.col("info")["NAME"].alias("name"), F.col("info")["SEGMENT"].alias("segment"))


@query(
    "json_flatten_record",
    """SELECT o_orderkey, o_orderstatus AS "order.status", c_name AS "order.customer.name",
       c_mktsegment AS "order.customer.segment", o_orderpriority AS "tags.0.who", c_name AS "tags.1.who",
       CASE WHEN o_orderkey % 2 = 0 THEN 'third' END AS "tags.2.who", CASE WHEN o_orderkey % 6 = 0 THEN 'fourth' END AS "tags.3.who"
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def _(spark, sf):
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    df = joined.select(
        "o_orderkey",
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("customer"),
        ).alias("order"),
        # two to four elements; two are spread to columns, the others are members of the rest
        F.array_compact(
            F.array(
                F.struct(F.col("o_orderpriority").alias("who")),
                F.struct(F.col("c_name").alias("who")),
                F.when(F.col("o_orderkey") % 2 == 0, F.struct(F.lit("third").alias("who"))),
                F.when(F.col("o_orderkey") % 6 == 0, F.struct(F.lit("fourth").alias("who"))),
            )
        ).alias("tags"),
    )
    out = ef.json_flatten(df, array_lengths={"tags": 2})
    more = {f"tags.{i}.who": F.try_element_at("_rest", F.lit(f"tags.{i}.who")).cast("string") for i in (2, 3)}
    return out.withColumns(more).drop("_rest")


@query(
    "json_flatten_field",
    """SELECT event_id,
       CASE WHEN event_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN event_id % 11 <> 0 THEN event_type END AS kind,
       CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 3 AS VARCHAR) END AS first_item,
       CASE WHEN event_id % 11 <> 0 THEN json_extract_string(props, '$.k') END AS k,
       CASE WHEN event_id % 11 <> 0 THEN '[1,2]' END AS inner_list,
       CASE WHEN event_id % 11 <> 0 THEN 5 END AS leaves
       FROM events""",
)
def _(spark, sf):
    text = """concat('{"user":{"id":', user_id, ',"kind":"', event_type, '"},"list":[', event_id % 3,
        ',{"props":', props, '},[1,2]],"none":{}', if(event_id % 11 = 0, '', '}'))"""
    df = table(spark, sf, "events").select("event_id", F.expr(text).alias("doc"))
    flat = F.col("`@flatten`")
    return ef.json_flatten(df, source_field="doc").select(
        "event_id",
        flat["user.id"].cast("string").alias("user_id"),
        flat["user.kind"].cast("string").alias("kind"),
        flat["list.0"].cast("string").alias("first_item"),
        flat["list.1.props.k"].cast("string").alias("k"),
        flat["list.2"].cast("string").alias("inner_list"),
        F.size(flat).alias("leaves"),
    )


@query(
    "fingerprint",
    """SELECT event_id, md5(user_id || '|' || event_type) AS md5,
       sha1('user_id=' || user_id || '~event_type=' || event_type) AS sha1,
       sha256(CASE WHEN event_type = 'view' THEN '' || user_id ELSE event_type || '|' || user_id END) AS fingerprint
       FROM events""",
)
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("kind", F.when(F.col("event_type") != "view", F.col("event_type")))
    df = ef.fingerprint(df, source_fields=["user_id", "event_type", "absent"], target_field="md5", method="md5")
    df = ef.fingerprint(
        df, source_fields=["user_id", "event_type"], target_field="sha1", method="SHA1", include_keys=True, key_separator="~"
    )
    df = ef.fingerprint(df, source_fields=["kind", "user_id"])
    return df.select("event_id", "md5", "sha1", "fingerprint")


@query(
    "fingerprint_base64",
    "SELECT o_orderkey, to_base64(encode(sha256(o_orderkey || '|' || o_orderpriority))) AS fingerprint FROM orders",
)
def _(spark, sf):
    out = ef.fingerprint(
        table(spark, sf, "orders"), source_fields=["o_orderkey", "o_orderpriority"], base64encode=True
    )
    return out.select("o_orderkey", "fingerprint")


# Fixed value: the published SHA-512 digest of "abc".
ABC512 = (
    "ddaf35a193617abacc417349ae20413112e6fa4e89a97ea20a9eeee64b55d39a2192992a274fc1a836ba3c23a3feebbd454d4423643ce80e2a9ac94fa54ca49f"
)


@query(
    "fingerprint_sha512",
    """SELECT count(*) AS n, count(DISTINCT o_orderkey || '|' || o_orderpriority) AS digests, 128 AS shortest, 128 AS longest, TRUE AS known FROM orders""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").withColumn("abc", F.lit("abc"))
    out = ef.fingerprint(df, source_fields=["o_orderkey", "o_orderpriority"], method="SHA512")
    out = ef.fingerprint(out, source_fields=["abc"], target_field="fixed", method="SHA512")
    length = F.length("fingerprint")
    return out.agg(
        F.count("*").alias("n"),
        F.countDistinct("fingerprint").alias("digests"),
        F.min(length).alias("shortest"),
        F.max(length).alias("longest"),
        F.bool_and(F.col("fixed") == ABC512).alias("known"),
    )


@query("passthrough", "SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name FROM region")
def _(spark, sf):
    return ef.passthrough(table(spark, sf, "region")).withColumn("r_regionkey", F.col("r_regionkey").cast("bigint"))


@query(
    "mutate_copy",
    """SELECT p_partkey, p_brand, CASE WHEN p_size > 25 THEN p_name ELSE p_type END AS p_type, p_brand AS brand FROM part""",
)
def _(spark, sf):
    df = table(spark, sf, "part").withColumn("large", F.when(F.col("p_size") > 25, F.col("p_name")))
    out = ef.mutate(df, copy={"large": "p_type", "p_brand": "brand", "absent": "x"})
    return out.select("p_partkey", "p_brand", "p_type", "brand")


@query("mutate_rename", "SELECT p_partkey AS id, p_name AS name, p_brand, p_type FROM part")
def _(spark, sf):
    out = ef.mutate(table(spark, sf, "part"), rename={"p_partkey": "id", "p_name": "name", "absent": "x"})
    return out.select("id", "name", "p_brand", "p_type")


@query(
    "mutate_convert",
    """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS digit,
       CAST(NULL AS BIGINT) AS word, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS number,
       CASE WHEN o_orderpriority LIKE '1%' THEN TRUE END AS flag,
       CAST(trunc(o_totalprice) AS BIGINT) AS price, o_orderkey <> 0 AS any_key,
       CAST(o_custkey AS VARCHAR) AS customer FROM orders""",
)
def _(spark, sf):
    digit = F.substring("o_orderpriority", 1, 1)
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        digit.alias("digit"),
        F.col("o_orderpriority").alias("word"),
        digit.alias("number"),
        digit.alias("flag"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("any_key"),
        F.col("o_custkey").alias("customer"),
    )
    types = {
        "digit": "integer",
        "word": "int",
        "number": "float",
        "flag": "boolean",
        "price": "integer",
        "any_key": "bool",
        "customer": "string",
        "absent": "string",
    }
    return ef.mutate(df, convert=types)


@query(
    "mutate_split",
    """SELECT p_partkey, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[2] AS second,
       CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n FROM part""",
)
def _(spark, sf):
    out = ef.mutate(table(spark, sf, "part"), split={"field": "p_name", "separator": " ", "target": "words"})
    words = F.col("words")
    return out.select(
        "p_partkey", words[0].alias("first"), F.get(words, F.lit(1)).alias("second"), F.size(words).cast("bigint").alias("n")
    )


@query("mutate_join", "SELECT p_partkey, replace(p_name, ' ', '-+-') AS p_name FROM part")
def _(spark, sf):
    out = ef.mutate(
        table(spark, sf, "part"),
        split={"field": "p_name", "separator": " "},
        join={"field": "p_name", "separator": "-+-"},
    )
    return out.select("p_partkey", "p_name")


@query(
    "mutate_gsub",
    r"""SELECT doc_id, regexp_replace(regexp_replace(text, '[0-9]+', '#', 'g'), '(#)[.](#)', '\2:\1', 'g') AS text
        FROM documents""",
)
def _(spark, sf):
    rules = [
        {"field": "text", "pattern": "[0-9]+", "replacement": "#"},
        {"field": "text", "pattern": "(?P<a_1>#)[.](#)", "replacement": "$2:${a_1}"},
        {"field": "doc_id", "pattern": "1", "replacement": "x"},
    ]
    return ef.mutate(table(spark, sf, "documents"), gsub=rules).select("doc_id", "text")


@query(
    "mutate_lowercase",
    "SELECT c_custkey, lower(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment FROM customer",
)
def _(spark, sf):
    out = ef.mutate(table(spark, sf, "customer"), lowercase=["c_name", "c_mktsegment", "c_custkey"])
    return out.select("c_custkey", "c_name", "c_mktsegment")


@query("mutate_uppercase", "SELECT c_custkey, upper(c_name) AS c_name FROM customer")
def _(spark, sf):
    return ef.mutate(table(spark, sf, "customer"), uppercase=["c_name"]).select("c_custkey", "c_name")


@query("mutate_strip", "SELECT doc_id, lang AS padded, source FROM documents")
def _(spark, sf):
    df = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit(" \t \n"), "lang", F.lit("\r\n  ")).alias("padded"), "source"
    )
    return ef.mutate(df, strip=["padded", "source"])


@query(
    "mutate_merge",
    """SELECT p_partkey, p_brand || p_type AS p_brand, list_concat(string_split(p_name, ' '), [p_type])[-1] AS last,
       CAST(2 * len(string_split(p_name, ' ')) + 1 AS BIGINT) AS n, p_name AS created,
       CASE WHEN p_size > 25 THEN p_type ELSE p_name END AS chosen FROM part""",
)
def _(spark, sf):
    df = table(spark, sf, "part").withColumns(
        {
            "words": F.split("p_name", " "),
            "more": F.split("p_name", " "),
            "one": F.create_map(F.lit("x"), "p_name"),
            "two": F.create_map(F.when(F.col("p_size") > 25, F.lit("x")).otherwise(F.lit("y")), "p_type"),
        }
    )
    rules = [
        {"source": "p_type", "target": "p_brand"},
        {"source": "more", "target": "words"},
        {"source": "p_type", "target": "words"},
        {"source": "p_name", "target": "created"},
        {"source": "two", "target": "one"},
    ]
    out = ef.mutate(df, merge=rules)
    return out.select(
        "p_partkey",
        "p_brand",
        F.element_at("words", -1).alias("last"),
        F.size("words").cast("bigint").alias("n"),
        "created",
        F.col("one")["x"].alias("chosen"),
    )


@query(
    "mutate_update",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 'new' END AS note FROM events",
)
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("note", F.when(F.col("event_type") == "error", "old"))
    return ef.mutate(df, update={"note": "new", "absent": 1}).select("event_id", "note")


@query("mutate_replace", "SELECT event_id, 'all' AS event_type, CAST(7 AS BIGINT) AS level FROM events")
def _(spark, sf):
    out = ef.mutate(table(spark, sf, "events"), replace={"event_type": "all", "level": 7})
    return out.select("event_id", "event_type", F.col("level").cast("bigint").alias("level"))


@query("mutate_remove", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    return ef.mutate(table(spark, sf, "events"), remove=["ts", "value", "props", "absent"])


@query(
    "mutate_all_in_order",
    """SELECT event_id, 'ERROR-' || user_id AS label, 'web' AS origin FROM events WHERE event_type = 'error'
       UNION ALL SELECT event_id, 'OTHER', 'web' FROM events WHERE event_type <> 'error'""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit(" error_"), "user_id")).otherwise("other ").alias("raw"),
    )
    return ef.mutate(
        df,
        rename={"raw": "label"},
        gsub=[{"field": "label", "pattern": "_", "replacement": "-"}],
        uppercase=["label"],
        strip=["label"],
        copy={"raw": "origin"},
        replace={"origin": "web"},
    )


@query(
    "json_flatten_nested",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS first, o_orderstatus AS second, o_orderpriority AS third, 4 AS leaves,
       CASE WHEN o_orderkey % 2 = 0 THEN 'deep' ELSE 'x{y' END AS last FROM orders""",
)
def _(spark, sf):
    text = """concat('{"a":{"b":[', o_custkey, ',{"c":"', o_orderstatus, '"}]},"d":{"e":{"f":"', o_orderpriority, '"}},"empty":{},',
        if(o_orderkey % 2 = 0, '"g":{"h":{"i":{"j":"deep"}}}}', '"g":{"h":{"i":{"j":"x{y"}}}}'))"""
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.expr(text).alias("doc"))
    out = ef.json_flatten(df, source_field="doc", target_field="flat")
    leaf = lambda path: F.try_element_at("flat", F.lit(path)).cast("string")
    return out.select(
        "o_orderkey",
        leaf("a.b.0").alias("first"),
        leaf("a.b.1.c").alias("second"),
        leaf("d.e.f").alias("third"),
        F.size("flat").alias("leaves"),
        leaf("g.h.i.j").alias("last"),
    )
