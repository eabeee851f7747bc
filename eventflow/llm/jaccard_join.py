"""Grouped prefix join: near-duplicate documents by Jaccard similarity of word shingles, exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, release, store
from .graph import components
from .shingles import pieces, shingle_sets

# Counters of the frequency sketch: 4 bytes each, the same at every size of input.
SKETCH = 1 << 20
SLICES = 16


def frequency_sketch(texts: DataFrame, k: int) -> np.ndarray:
    """How often the shingles that fall on each of SKETCH counters occur, over all documents.

    Each partition sends its counters in slices; the slices are added up in as many groups.  What
    reaches the driver has a fixed size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for piece in pieces(batch, "text"):
                values, _ = shingle_sets(piece.column("text"), k)
                counters += np.bincount((values & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
        for i, part in enumerate(np.split(counters, SLICES)):
            yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "counters": [part.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(part, np.uint32)
                sums[i] = sums[i] + part if i in sums else part
        for i, part in sums.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "counters": [part.tobytes()]})

    ddl = "slice int, counters binary"
    sliced = texts.select("text").mapInArrow(count, ddl).repartition(SLICES, "slice").mapInArrow(add, ddl)
    out = np.zeros((SLICES, SKETCH // SLICES), np.uint32)
    for row in sliced.collect():
        out[row["slice"]] = np.frombuffer(row["counters"], np.uint32)
    return out.reshape(-1)


SET = "doc_id bigint, n int, d1 bigint, d2 bigint, p1 bigint, prefix array<bigint>"


def described_sets(docs: DataFrame, k: int, over: int, under: int, sketch) -> DataFrame:
    """``SET`` for each document: size, digest of the set, digest of the prefix, and the prefix.

    The shingles of a set are ordered by their counter in the sketch, rarest first, and by value; two sets with at least ``over/under``
    in common of their union share one of their first ``n - ceil(n * over / under) + 1``.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = sketch.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                values, offsets = shingle_sets(piece.column("text"), k)
                n = np.diff(offsets)
                row = np.repeat(np.arange(len(n)), n)
                often = counters[(values & np.uint64(SKETCH - 1)).astype(np.int64)]
                order = np.lexsort((values, often, row))
                ranked = values[order]
                length = np.where(n > 0, n + (-n * over) // under + 1, 0)
                digests = np.zeros((len(n), 3), np.uint64)
                data, ranks = values.tobytes(), ranked.tobytes()
                prefix_at = np.concatenate([[0], np.cumsum(length)])
                for i in range(len(n)):
                    a = int(offsets[i])
                    d = xxhash.xxh3_128_intdigest(data[8 * a : 8 * int(offsets[i + 1])])
                    p = xxhash.xxh3_64_intdigest(ranks[8 * a : 8 * (a + int(length[i]))])
                    digests[i] = d >> 64, d & 0xFFFFFFFFFFFFFFFF, p
                inside = np.arange(len(ranked)) - offsets[:-1][row] < length[row] if len(ranked) else np.zeros(0, bool)
                prefix = pa.ListArray.from_arrays(pa.array(prefix_at, pa.int32()), pa.array(ranked[inside].view(np.int64)))
                d = digests.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(n, pa.int32()), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(d[:, 2]), prefix],
                    names=["doc_id", "n", "d1", "d2", "p1", "prefix"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(describe, SET)


def _within(a: str, b: str, over: int, under: int) -> Column:
    """Sizes of two sets that can still be similar enough."""
    low, high = F.least(a, b), F.greatest(a, b)
    return low * under >= high * over


def _reach(a: str, i: str, b: str, j: str, over: int, under: int) -> Column:
    """Two sets that first meet at places ``i`` and ``j`` can still share what the similarity asks for."""
    # shared / (a + b - shared) >= over / under  <=>  shared * (over + under) >= (a + b) * over
    shared = F.least(F.col(a) - F.col(i), F.col(b) - F.col(j))
    return shared * (over + under) >= (F.col(a) + F.col(b)) * over


def verified(pairs: DataFrame, docs: DataFrame, k: int, over: int, under: int) -> DataFrame:
    """Of the pairs ``a, b`` of doc_ids, those whose whole sets are similar enough."""
    ends = broadcast_if_small(store(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ends"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                values, offsets = shingle_sets(piece.column("text"), k)
                data = values.tobytes()
                sets = [data[8 * a : 8 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(sets, pa.binary())], names=["doc_id", "set"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(bool(under * shared >= over * (len(x) + len(y) - shared)))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    sets = store(docs.join(ends, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(build, "doc_id bigint, set binary"), "sets")
    x = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint")


def similar_documents(docs: DataFrame, k: int = 5, over: int = 80, under: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the components of "Jaccard similarity of the shingle sets >= over/under".

    Words are lower-cased (A-Z) runs of non-white-space of the whole text; a set holds the distinct
    ``k``-word shingles (see ``shingle_sets``).  Sets without shingles are linked with nothing.  A row without doc_id gets no component of its
    own: its set links nothing unless a row with a doc_id has the same set.  Rows that share a doc_id share a component.  An empty
    table gives an empty table; other columns are ignored.

    1. Equal sets become one class, named by its smallest doc_id.
    2. Classes with the same prefix and size become one group; the groups, not the documents, are posted under their prefix shingles.
    3. Under each shingle the groups are paired with one pivot, the one whose shingle comes earliest, and in each group the members with
       one member.  Pairs pass the filters of size and place, are expanded to members and verified on whole sets; so most of a large
       group of copies is connected by as many pairs as it has members.
    4. Then only pairs between different components are left to try, under shingles that still have several: members outside their shingle's main
       component against the others.  So every pair that passes the filters is verified or already connected, without emitting all pairs of a dense group.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = spark.sparkContext.broadcast(frequency_sketch(texts, k))
    sets = store(described_sets(texts, k, over, under, sketch), "sets")
    light = sets.select("doc_id", "n", "d1", "d2")
    classes = light.filter("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("class"))
    classes = store(classes, "classes")
    release(spark)

    # one row for each class; its prefix is that of any of its documents
    heads = sets.join(classes.select(F.col("class").alias("doc_id"), "d1", "d2", "n"), ["doc_id", "d1", "d2", "n"])
    heads = store(heads.dropDuplicates(["doc_id", "d1", "d2", "n"]), "heads")
    crowds = heads.groupBy("p1", "n").agg(F.min("doc_id").alias("group"), F.count("*").alias("size")).filter("size > 1")
    crowds = broadcast_if_small(store(crowds.select("p1", "n", "group"), "crowds"))
    inside = heads.select("doc_id", "p1", "n").join(crowds, ["p1", "n"]).select("group", F.col("doc_id").alias("member"))
    inside = store(inside, "inside")
    # all but the groups' other members are posted, straight from the stored classes
    others = broadcast_if_small(store(inside.filter("member != group").select(F.col("member").alias("doc_id")).distinct(), "others"))
    posted = heads.join(others, "doc_id", "left_anti")
    posted = posted.select(F.col("doc_id").alias("g"), "n", F.posexplode("prefix").alias("at", "token"))
    posted = posted.withColumn("of", F.struct("at", "g", "n"))
    pivots = posted.groupBy("token").agg(F.count("*").alias("posts"), F.min("of").alias("pivot")).filter("posts > 1")
    shared = posted.select("token", "g", "n", "at").join(pivots.select("token", "pivot"), "token")
    shared = store(shared.select("token", "g", "n", "at", F.col("pivot.g").alias("h"), F.col("pivot.n").alias("m"), F.col("pivot.at").alias("to")), "shared")

    stars = shared.filter("g != h").filter(_within("n", "m", over, under) & _reach("n", "at", "m", "to", over, under))
    stars = stars.select(F.least("g", "h").alias("a"), F.greatest("g", "h").alias("b")).distinct()
    first = store(_expanded(stars, inside).union(inside.filter("member != group").select("group", "member")).distinct(), "pairs")
    links = store(verified(first, texts, k, over, under), "links")
    labels = components(links)
    release(spark)

    rest = _left(shared, inside, labels, over, under)
    rest = store(rest.join(first, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        links = store(links.union(verified(rest, texts, k, over, under)), "links")
        labels = components(links)

    moved = broadcast_if_small(store(labels.filter("id != component"), "moved"))
    named = store(classes.join(moved, F.col("class") == F.col("id"), "left").select("d1", "d2", "n", F.coalesce("component", "class").alias("component")), "named")
    # only classes of several documents, or linked ones, say more than the document itself
    out = light.join(named, ["d1", "d2", "n"], "left")
    return out.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _expanded(pairs: DataFrame, inside: DataFrame) -> DataFrame:
    """Pairs of groups as pairs of their members; a group without other members stands for itself."""
    m = inside.select("group", "member")
    left = pairs.join(m.toDF("a", "x"), "a", "left").select(F.coalesce("x", "a").alias("a"), "b")
    both = left.join(m.toDF("b", "y"), "b", "left").select("a", F.coalesce("y", "b").alias("b"))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")


def _left(shared: DataFrame, inside: DataFrame, labels: DataFrame, over: int, under: int) -> DataFrame:
    """Pairs of members in different components that pass the filters, under tokens with more than one component."""
    # a group counts as one component only if all its members are in it
    of = labels.select(F.col("id").alias("member"), "component")
    own = inside.join(of, "member", "left").select("group", F.coalesce("component", "member").alias("c"))
    split = own.groupBy("group").agg(F.min("c").alias("c"), (F.min("c") != F.max("c")).alias("open")).toDF("g", "gc", "open")
    posts = shared.join(split, "g", "left").join(labels.toDF("g", "lc"), "g", "left")
    posts = posts.select("token", "g", "n", "at", "h", F.coalesce("gc", "lc", "g").alias("c"), F.coalesce("open", F.lit(False)).alias("open"))
    posts = store(posts, "posts")
    main = posts.filter("g = h").select("token", F.col("c").alias("main"))
    # tokens with members outside their pivot's component
    outside = posts.join(main, "token").filter("c != main or open")
    outside = store(outside.select("token", "g", "n", "at", "c", "open"), "outside")
    others = posts.join(outside.select("token").distinct(), "token", "left_semi")
    others = others.select("token", F.col("g").alias("h"), F.col("n").alias("m"), F.col("at").alias("to"), F.col("c").alias("d"), F.col("open").alias("open2"))
    near = _within("n", "m", over, under) & _reach("n", "at", "m", "to", over, under)
    apart = (F.col("g") != F.col("h")) & ((F.col("c") != F.col("d")) | F.col("open") | F.col("open2"))
    pairs = outside.join(others, (outside["token"] == others["token"]) & apart & near)
    pairs = pairs.select(F.least("g", "h").alias("a"), F.greatest("g", "h").alias("b")).distinct()
    # members of one group that are in different components
    return _expanded(pairs, inside).union(_apart_in_groups(inside, of)).distinct()


def _apart_in_groups(inside: DataFrame, of: DataFrame) -> DataFrame:
    """Pairs of members of one group in different components, one of them outside that of the group's first member."""
    placed = inside.join(of, "member", "left").select("group", "member", F.coalesce("component", "member").alias("c"))
    main = placed.filter("member = group").select("group", F.col("c").alias("main"))
    out = placed.join(main, "group").filter("c != main").select("group", F.col("member").alias("x"), F.col("c").alias("cx"))
    pairs = out.join(placed, "group").filter("x != member and cx != c")
    return pairs.select(F.least("x", "member").alias("a"), F.greatest("x", "member").alias("b"))
