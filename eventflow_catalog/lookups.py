"""Look-up joins."""

from pyspark.sql import functions as F

import eventflow as ef

from .base import query, table

# Every tenth event has a user that is no customer.
USER = "user_id + CASE WHEN event_id % 10 = 0 THEN 1000000000 ELSE 0 END"
ENRICHED = f"""SELECT event_id, c_name AS name, c_mktsegment AS segment FROM events
    LEFT JOIN customer ON c_custkey = {USER}"""


def _customers(spark, sf):
    """Customers, with a later second row per key that must never win."""
    rows = table(spark, sf, "customer").withColumn("pos", F.lit(1))
    later = rows.withColumns({"pos": F.lit(2), "c_name": F.lit("later")})
    return rows.unionByName(later)


def _enriched(spark, sf, broadcast):
    out = ef.enricher(
        table(spark, sf, "events").withColumn("user_id", F.expr(USER)),
        enricher_id="customers",
        source_field="user_id",
        target_field="customer",
        index_column="c_custkey",
        order_by="pos",
        tables={"customers": _customers(spark, sf)},
        broadcast=broadcast,
    )
    return out.select("event_id", F.col("customer.c_name").alias("name"), F.col("customer.c_mktsegment").alias("segment"))


@query("enricher", ENRICHED)
def _(spark, sf):
    return _enriched(spark, sf, None)


@query("enricher_shuffle_join", ENRICHED)
def _(spark, sf):
    return _enriched(spark, sf, False)


@query(
    "enricher_default_target",
    "SELECT c_custkey, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def _(spark, sf):
    out = ef.enricher(
        table(spark, sf, "customer"),
        enrichment="nations",
        source_field="c_nationkey",
        tables={"nations": table(spark, sf, "nation")},
    )
    return out.select("c_custkey", F.col("`src.c_nationkey-nations`.n_name").alias("nation"))


GEO = """SELECT event_id, n_name AS country, CAST(n_nationkey AS DOUBLE) AS latitude,
    CASE WHEN n_name IS NOT NULL THEN -CAST(n_nationkey AS DOUBLE) / 2 END AS lon FROM events
    LEFT JOIN nation ON n_nationkey = user_id % 30 AND event_id % 9 <> 0"""


def _located(spark, sf, broadcast):
    """One range of 2^24 addresses per nation; the first octet of some addresses is in none of them."""
    ranges = table(spark, sf, "nation").select(
        F.expr("concat(n_nationkey, '.0.0.0')").alias("start_ip"),
        F.expr("concat(n_nationkey, '.255.255.255')").alias("end_ip"),
        F.col("n_name").alias("country_name"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        (-F.col("n_nationkey").cast("double") / 2).alias("longitude"),
    )
    address = """concat(user_id % 30, '.', event_id % 256, '.', user_id % 256, '.', if(event_id % 9 = 0, '999', event_id % 200))"""
    df = table(spark, sf, "events").select("event_id", F.struct(F.expr(address).alias("src")).alias("net"))
    out = ef.geoip(
        df,
        source_field="net.src",
        fields=["country", "latitude", "location"],
        tables={"geoip": ranges},
        broadcast=broadcast,
    )
    return out.select("event_id", "geoip.country", "geoip.latitude", F.col("geoip.location.lon").alias("lon"))


@query("geoip", GEO)
def _(spark, sf):
    return _located(spark, sf, None)


@query("geoip_shuffle_join", GEO)
def _(spark, sf):
    return _located(spark, sf, False)


# All of 10/8, one /16 in it for each user, and 200 ranges of a /24 or less in that.
NESTED = """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'net' WHEN event_id % 3 = 1 THEN 'block' || (user_id % 200) ELSE 'wide' END AS city FROM events"""


def _nested(spark, sf, broadcast):
    users = spark.range(200).withColumnRenamed("id", "u")
    row = lambda df, a, b, city: df.select(F.expr(a).alias("start_ip"), F.expr(b).alias("end_ip"), F.expr(city).alias("city_name"))
    ranges = row(spark.range(1), "'10.0.0.0'", "'10.255.255.255'", "'wide'")
    ranges = ranges.union(row(spark.range(1), "'10.7.0.0'", "'10.7.255.255'", "'net'"))
    ranges = ranges.union(row(users, "concat('10.7.', u, '.16')", "concat('10.7.', u, '.99')", "concat('block', u)"))
    address = """CASE event_id % 3 WHEN 0 THEN concat('10.7.', user_id % 200, '.', 100 + event_id % 100)
        WHEN 1 THEN concat('10.7.', user_id % 200, '.', 16 + event_id % 84) ELSE concat('10.', 8 + user_id % 200, '.1.1') END"""
    df = table(spark, sf, "events").select("event_id", F.expr(address).alias("ip_address"))
    out = ef.geoip(df, fields=["city_name"], tables={"geoip": ranges}, broadcast=broadcast)
    return out.select("event_id", "geoip.city")


@query("geoip_nested", NESTED)
def _(spark, sf):
    return _nested(spark, sf, None)


@query("geoip_nested_shuffle_join", NESTED)
def _(spark, sf):
    return _nested(spark, sf, False)


# A range of one /16 for each order, up to 5,000 addresses wide, and all of it; they nest and overlap.
DENSE = """WITH ranges AS (SELECT DISTINCT a, least(a + w, 65535) AS b FROM
        (SELECT (o_orderkey * 7) % 40000 AS a, (o_custkey * 37) % 5000 AS w FROM orders UNION ALL SELECT 0, 65535)),
    asked AS (SELECT event_id, (event_id * 7919) % 65536 AS x FROM events),
    best AS (SELECT x, min({w: b - a, a: a, b: b}) AS r FROM (SELECT DISTINCT x FROM asked) JOIN ranges ON a <= x AND x <= b GROUP BY x)
    SELECT event_id, 'r' || (r).a || '-' || (r).b AS city FROM asked LEFT JOIN best USING (x)"""


@query("geoip_dense", DENSE)
def _(spark, sf):
    spans = table(spark, sf, "orders").select(F.expr("(o_orderkey * 7) % 40000").alias("a"), F.expr("(o_custkey * 37) % 5000").alias("w"))
    spans = spans.union(spark.range(1).selectExpr("0", "65535")).selectExpr("a", "least(a + w, 65535) AS b")
    address = "concat('10.7.', {0} div 256, '.', {0} % 256)"
    ranges = spans.select(
        F.expr(address.format("a")).alias("start_ip"),
        F.expr(address.format("b")).alias("end_ip"),
        F.expr("concat('r', a, '-', b)").alias("city_name"),
    )
    df = table(spark, sf, "events").selectExpr("event_id", "(event_id * 7919) % 65536 AS x")
    df = df.select("event_id", F.expr(address.format("x")).alias("ip_address"))
    return ef.geoip(df, fields=["city_name"], tables={"geoip": ranges}).select("event_id", "geoip.city")


@query(
    "geoip_v6",
    """SELECT event_id, n_name AS country FROM events LEFT JOIN nation ON n_nationkey = user_id % 30""",
)
def _(spark, sf):
    net = "lpad(lower(hex(n_nationkey)), 4, '0')"
    ranges = table(spark, sf, "nation").select(
        F.expr(f"concat('2001:', {net}, '::')").alias("start_ip"),
        F.expr(f"concat('2001:', {net}, ':ffff:ffff:ffff:ffff:ffff:ffff')").alias("end_ip"),
        F.col("n_name").alias("country_name"),
    )
    address = "concat('2001:', lower(hex(user_id % 30)), '::', lower(hex(event_id % 65536)))"
    df = table(spark, sf, "events").select("event_id", F.expr(address).alias("ip_address"))
    return ef.geoip(df, fields=["country_name"], tables={"geoip": ranges}).select("event_id", "geoip.country")


@query(
    "dns",
    """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN host ELSE '10.0.' || (length(host) % 256) || '.1' END AS host,
       CASE WHEN page_id % 4 <> 0 THEN '10.0.' || (length(host) % 256) || '.1' END AS copy_resolved
       FROM (SELECT page_id, regexp_extract(url, '://([^/:?#]+)', 1) || CASE WHEN page_id % 4 = 0 THEN '.unknown' ELSE '' END AS host FROM pages)""",
)
def _(spark, sf):
    hosts = table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "://([^/:?#]+)", 1).alias("host"))
    names = hosts.select(
        F.col("host").alias("name"), F.expr("concat('10.0.', length(host) % 256, '.1')").alias("resolved")
    ).distinct()
    df = hosts.withColumn("host", F.expr("concat(host, if(page_id % 4 = 0, '.unknown', ''))")).withColumn("copy", F.col("host"))
    df = ef.dns(df, resolve=["copy"], action="append", tables={"dns": names})
    return ef.dns(df, resolve=["host", "absent"], tables={"dns": names}).select("page_id", "host", "copy_resolved")


AGENT = """CASE event_id % 4
    WHEN 0 THEN concat('Mozilla/5.0 (Windows NT 10.0; Win64) AppleWebKit/537.36 Chrome/', 80 + user_id % 40, '.0.', user_id, '.1 Safari/537.36')
    WHEN 1 THEN concat('Mozilla/5.0 (iPhone; CPU iPhone OS 17_', user_id % 5, ' like Mac OS X) AppleWebKit/605 Version/17.', user_id % 5, ' Mobile/15E148 Safari/604.1')
    WHEN 2 THEN concat('Mozilla/5.0 (Linux; Android 14; Pixel ', user_id % 9, ') Gecko/120 Firefox/', 100 + user_id % 20, '.0')
    ELSE concat('tool ', user_id) END"""
AGENTS = """SELECT event_id,
    CASE event_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Mobile Safari' WHEN 2 THEN 'Firefox' ELSE 'Other' END AS name,
    CASE event_id % 4 WHEN 0 THEN (80 + user_id % 40) || '.0.' || user_id WHEN 1 THEN '17.' || (user_id % 5)
        WHEN 2 THEN (100 + user_id % 20) || '.0' END AS version,
    CASE event_id % 4 WHEN 0 THEN 'Windows' WHEN 1 THEN 'iOS' WHEN 2 THEN 'Android' ELSE 'Other' END AS os,
    CASE event_id % 4 WHEN 0 THEN '10' WHEN 1 THEN '17.' || (user_id % 5) WHEN 2 THEN '14' END AS os_version,
    CASE event_id % 4 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'iPhone' WHEN 2 THEN 'Pixel ' || (user_id % 9) ELSE 'Other' END AS device,
    CASE event_id % 4 WHEN 1 THEN 'Apple' WHEN 2 THEN 'Google' END AS device_brand FROM events"""


def _agents(spark, sf, distinct):
    df = table(spark, sf, "events").select("event_id", F.expr(AGENT).alias("user_agent"))
    names = ["name", "version", "os", "os_version", "device", "device_brand"]
    return ef.useragent(df, distinct=distinct).select("event_id", *[f"ua.{n}" for n in names])


@query("useragent", AGENTS)
def _(spark, sf):
    return _agents(spark, sf, False)


@query("useragent_distinct", AGENTS)
def _(spark, sf):
    return _agents(spark, sf, True)
