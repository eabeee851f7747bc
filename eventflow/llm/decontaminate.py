"""Benchmark decontamination: SimHash windows of item size, multi-index Hamming search, exact verification."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, broadcast_if_small, store

SHINGLE = 5
SIMILARITY = 0.8
# Fingerprints of 64 bits; those that differ in at most RADIUS bits agree in one of RADIUS + 1 blocks.
BITS, RADIUS = 64, 16


def words_of(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def shingles_of(words: str, k: int) -> Column:
    """Hash of the ``k`` words from each place on that has so many."""
    places = F.slice(F.col(words), F.lit(1), F.greatest(F.lit(0), F.size(words) - (k - 1)))
    if k == 1:
        return F.transform(places, lambda w: F.xxhash64(w))
    return F.transform(places, lambda w, i: F.xxhash64(w, *[F.get(F.col(words), i + j) for j in range(1, k)]))


def with_simhash(df: DataFrame, words: str, name: str) -> DataFrame:
    """Add the SimHash of a column of words: each bit is what most of the words' hashes have there."""
    n = F.size(words)
    hashes = F.transform(F.col(words), lambda w: F.xxhash64(w))
    ones = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda b: F.aggregate(hashes, F.lit(0), lambda a, h: a + F.call_function("getbit", h, b).cast("int")),
    )
    # the sign bit apart, as 2^63 is no long
    low = F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 2)),
        F.lit(0).cast("long"),
        lambda a, b: a.bitwiseOR(F.when(F.get(F.col("__ones"), b) * 2 > n, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))),
    )
    sign = F.when(F.get(F.col("__ones"), F.lit(BITS - 1)) * 2 > n, F.lit(-(2**63)).cast("long")).otherwise(F.lit(0).cast("long"))
    return df.withColumn("__ones", ones).withColumn(name, low.bitwiseOR(sign)).drop("__ones")


def blocks(print_: str, radius: int) -> Column:
    """The fingerprint's bits in ``radius + 1`` blocks, those of the front one bit wider."""
    n, out, at = radius + 1, [], 0
    for i in range(n):
        width = BITS // n + (i < BITS % n)
        out.append(F.shiftrightunsigned(print_, at).bitwiseAND(F.lit((1 << width) - 1)))
        at += width
    return F.array(*out)


def leaks(
    docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS
) -> DataFrame:
    """Benchmark items found in documents: ``doc_id, print, item_id, start, length, distance, similarity``.

    A window of an item's length in words (the whole document if that is shorter) is a hit if the weighted Jaccard similarity of the
    multisets of ``k``-word shingles is at least ``similarity``; a shingle weighs by how few items have it.
    ``start`` is the place of the best window, the earliest at a tie; ``print`` is ``xxhash64`` of the text, which with doc_id names the row.

    1. A window without a shingle in common with any item has similarity 0, so only windows laid through a shingle of some item
       are fingerprinted; that is a hash join of the documents' shingles with the items'.
    2. Windows and items get SimHash fingerprints of their words.  Equal blocks (``radius + 1`` of them) find all
       items of that size within ``radius`` bits.
    3. The similarity is computed from the shingles themselves.

    Words are lower-cased runs of non-white-space of the whole text.  Null and empty texts have no windows, items without words none to find; an
    item with fewer than ``k`` words is one shingle.  Rows equal in doc_id and text give one result.  Empty tables give no rows.  Other columns are ignored.
    """
    items = benchmark.select("item_id", words_of("text").alias("words")).filter("size(words) > 0")
    items = items.withColumns({"length": F.size("words"), "k": F.least(F.size("words"), F.lit(k))})
    items = store(with_simhash(items, "words", "item_print"), "items")
    kinds = sorted(r["k"] for r in items.select("k").distinct().collect())  # at most k values

    base = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"), "text")
    keys = ["doc_id", "print"]
    found, weighed = None, None
    for n in kinds:
        mine = items.filter(F.col("k") == n)
        known = mine.select("item_id", "length", F.posexplode(shingles_of("words", n)).alias("at", "shingle"))
        counts = known.groupBy("item_id", "shingle").agg(F.count("*").alias("times")).withColumn("k", F.lit(n))
        weighed = counts if weighed is None else weighed.union(counts)
        # one row for each shingle: the windows that can be laid through it
        laid = known.groupBy("shingle").agg(F.collect_set(F.struct("at", "length")).alias("ways"))
        laid = broadcast_if_small(store(laid, "laid"))
        worded = base.select(*keys, words_of("text").alias("words"))
        own = worded.select(*keys, F.size("words").alias("n"), F.posexplode(shingles_of("words", n)).alias("place", "shingle"))
        through = own.join(laid, "shingle").select(*keys, "n", "place", F.explode("ways").alias("way"))
        length = F.least(F.col("way.length"), F.col("n"))
        start = F.greatest(F.lit(0), F.least(F.col("place") - F.col("way.at"), F.col("n") - length))
        part = through.select(*keys, start.alias("start"), F.col("way.length").alias("size"), length.alias("length")).distinct()
        found = part if found is None else found.union(part)
    if found is None:
        return base.sparkSession.createDataFrame([], _schema(docs, benchmark))
    windows = found.groupBy(*keys).agg(F.collect_set(F.struct("start", "length", "size")).alias("windows"))
    windows = broadcast_if_small(store(windows, "windows")).withColumnRenamed("doc_id", "of").withColumnRenamed("print", "by")
    same = (F.col("print") == F.col("by")) & F.col("doc_id").eqNullSafe(F.col("of"))
    cut = base.join(windows, same).dropDuplicates(keys).withColumn("words", words_of("text"))
    cut = cut.select(*keys, "words", F.explode("windows").alias("w"))
    cut = cut.select(*keys, "w.start", "w.length", "w.size", F.slice("words", F.col("w.start") + 1, F.col("w.length")).alias("words"))
    cut = store(with_simhash(cut, "words", "window_print"), "cut")

    sides = items.select("item_id", F.col("length").alias("size"), "item_print", F.posexplode(blocks("item_print", radius)).alias("block", "bits"))
    sides = broadcast_if_small(store(sides, "blocks"))
    near = cut.select(*keys, "start", "length", "size", "window_print", F.posexplode(blocks("window_print", radius)).alias("block", "bits"))
    near = near.join(sides, ["size", "block", "bits"])
    distance = F.bit_count(F.col("window_print").bitwiseXOR(F.col("item_print")))
    window = [*keys, "start", "length", "size"]
    near = near.withColumn("distance", distance).filter(F.col("distance") <= radius).select(*window, "item_id", "distance").distinct()

    shares = weighed.groupBy("shingle", "k").agg(F.countDistinct("item_id").alias("items"))
    total = items.count()
    weight = F.log(1 + F.lit(float(total)) / F.col("items"))
    weighed = weighed.join(shares, ["shingle", "k"]).withColumn("weight", weight)
    sums = weighed.groupBy("item_id").agg(F.sum(F.col("times") * F.col("weight")).alias("all"))
    weighed = broadcast_if_small(store(weighed.join(sums, "item_id").select("item_id", "shingle", "times", "weight", "all"), "weighed"))
    fresh = F.lit(math.log(1 + total))  # the weight of a shingle that no item has
    hits = None
    for n in kinds:
        mine = F.broadcast(items.filter(F.col("k") == n).select("item_id")) if total <= 10_000 else items.filter(F.col("k") == n).select("item_id")
        own = near.join(mine, "item_id").join(cut.select(*[F.col(c).alias(f"w_{c}") for c in window], "words"), _equal(window))
        own = own.select(*window, "item_id", "distance", F.explode_outer(shingles_of("words", n)).alias("shingle"))
        own = own.groupBy(*window, "item_id", "distance", "shingle").agg(F.count("shingle").alias("own"))
        hits = own if hits is None else hits.union(own)
    both = hits.join(weighed, ["item_id", "shingle"], "left")
    shared = F.coalesce(F.least("own", "times") * F.col("weight"), F.lit(0.0))
    weigh = F.col("own") * F.coalesce("weight", fresh)
    scored = both.groupBy(*window, "item_id", "distance").agg(
        F.sum(shared).alias("shared"), F.sum(weigh).alias("mine"), F.max("all").alias("all")
    )
    alike = F.col("shared") / (F.col("mine") + F.col("all") - F.col("shared"))
    scored = scored.withColumn("similarity", alike).filter(F.col("similarity") >= similarity - 1e-9)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "length", "distance")).alias("best")
    return scored.groupBy(*keys, "item_id").agg(best).select(
        *keys, "item_id", (-F.col("best.back")).alias("start"), "best.length", "best.distance", "best.similarity"
    )


def _equal(columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).eqNullSafe(F.col(f"w_{c}"))
    return out


def _schema(docs: DataFrame, benchmark: DataFrame) -> str:
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    return f"doc_id {kinds[0]}, print bigint, item_id {kinds[1]}, start int, length int, distance int, similarity double"


def without_leaks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns as they are."""
    bad = broadcast_if_small(store(found.select(F.col("doc_id").alias("__of"), F.col("print").alias("__by")).distinct(), "leaked"))
    same = F.col("doc_id").eqNullSafe(F.col("__of")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__by"))
    return docs.join(bad, same, "left_anti")
