"""The sweep over points and ranges against brute force, and address look-ups by it."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

import eventflow as ef
from eventflow.operators import enrich
from eventflow.operators.range_sweep import narrowest


def word(n):
    return n.to_bytes(2)


def best(point, ranges):
    around = [(b - a, a, b) for a, b in ranges if a <= point <= b]
    return min(around)[1:] if around else None


SHAPES = {
    "random": lambda rng: (rng.randrange(60000), rng.randrange(5000)),
    "onion": lambda rng: (lambda k: (k, 2 * (30000 - k)))(rng.randrange(30000)),
    "same_start": lambda rng: (777, rng.randrange(60000)),
    "same_end": lambda rng: (lambda a: (a, 60001 - a))(rng.randrange(60000)),
    "everything": lambda rng: (0, 65535),
    "single": lambda rng: (rng.randrange(65536), 0),
}


@pytest.mark.parametrize(("shape", "parts"), [*((s, 7) for s in SHAPES), ("mixed", 7), ("mixed", 1)])
def test_sweep_is_brute_force(spark, shape, parts):
    rng = random.Random(shape)
    make = [SHAPES[shape]] if shape != "mixed" else list(SHAPES.values())
    ranges = {(a, min(a + n, 65535)) for a, n in (rng.choice(make)(rng) for _ in range(300))}
    points = sorted({65535, *rng.sample(range(65536), 700), *(a for a, _ in list(ranges)[:50]), *(b for _, b in list(ranges)[:50])})
    p = spark.createDataFrame([(word(x),) for x in points], "point binary").repartition(3)
    r = spark.createDataFrame([(word(a), word(b)) for a, b in ranges], "start binary, end binary").repartition(3)
    got = {int.from_bytes(x.point): (int.from_bytes(x.start), int.from_bytes(x.end)) for x in narrowest(p, r, parts).collect()}
    assert got == {x: best(x, ranges) for x in points if best(x, ranges)}


def test_sweep_of_nothing(spark):
    p = spark.createDataFrame([(word(5),)], "point binary")
    r = spark.createDataFrame([(word(1), word(9))], "start binary, end binary")
    assert narrowest(p, r.limit(0)).collect() == [] and narrowest(p.limit(0), r).collect() == []
    assert narrowest(p.limit(0), r.limit(0)).collect() == []


def test_dense_addresses(spark):
    """Thousands of nested and overlapping ranges in one /16, and ranges of the other kind of address."""
    rng, base = random.Random(8), int(ipaddress.ip_address("10.7.0.0"))
    text = lambda n: str(ipaddress.ip_address(n))
    ranges = {(base + i, base + 65535 - i) for i in range(0, 20000, 10)}
    ranges |= {(a, min(a + rng.randrange(300), base + 65535)) for a in (base + rng.randrange(65536) for _ in range(3000))}
    rows = [(text(a), text(b), f"{a}-{b}") for a, b in ranges] + [("2001:db8::", "2001:db8::ffff", "six"), ("bad", "1.2.3.4", "bad")]
    table = spark.createDataFrame(rows, "start_ip string, end_ip string, city_name string")
    asked = [base + rng.randrange(65536) for _ in range(1500)] + [base - 1, base + 65536]
    names = [text(a) for a in asked] + ["2001:db8::5", "2001:db9::", "no address", None, None]
    df = spark.createDataFrame(list(enumerate(names)), "id int, ip_address string").withColumn("geoip", F.lit("old"))
    want = {i: (lambda r: f"{r[0]}-{r[1]}" if r else None)(best(a, ranges)) for i, a in enumerate(asked)}
    want |= {len(asked): "six"} | {i: None for i in range(len(asked) + 1, len(names))}
    for broadcast in (None, True, False):
        out = ef.geoip(df.drop("geoip"), fields=["city"], tables={"geoip": table}, broadcast=broadcast)
        assert {r.id: r.geoip and r.geoip.city for r in out.collect()} == want


def test_both_ways_agree(spark):
    rows = [("1.0.0.0", "1.255.255.255", "a"), ("1.2.0.0", "1.2.3.4", "b"), ("1.2.0.0", "1.2.3.4", "a2"), ("0.0.0.0", "255.255.255.255", "c")]
    rows += [("1.2.3.0", "1.2.4.9", "d"), ("::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "e")]
    table = spark.createDataFrame(rows, "start_ip string, end_ip string, city_name string")
    asked = ["1.2.3.4", "1.2.0.0", "1.2.4.9", "1.2.4.10", "9.9.9.9", "::1", "2001::", "x", None]
    df = spark.createDataFrame(list(enumerate(asked)), "id int, ip_address string")
    city = lambda b: {r.id: r.geoip and r.geoip.city for r in ef.geoip(df, fields=["city"], tables={"geoip": table}, broadcast=b).collect()}
    assert city(None) == city(False) == dict(enumerate(["d", "a2", "d", "a", "c", "e", "e", None, None]))
    assert enrich.BUCKET_RANGES > 0
