"""Resharding by minimum-cost flow: whole stretches of the old shards move so that the fewest bytes do."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import quoted, running, without

# A group of equal texts up to this part of a shard stays together.
WHOLE = 0.02

OUTPUT = ("size", "text_crc32", "law", "shard", "slot", "moved")


def min_cost_flow(
    supply: Sequence[int], capacity: Sequence[int], cost: Callable[[int, int], int]
) -> dict[tuple[int, int], int]:
    """Bytes to send from each old shard to each new one, at the least total cost.

    Successive shortest paths over the bipartite graph of shards; its size is the number of shards, not of
    rows.  The capacities must hold the supply.
    """
    old, new = range(len(supply)), range(len(capacity))
    flow: dict[tuple[int, int], int] = {}
    left, room = list(supply), list(capacity)
    while any(left):
        dist = {("o", i): 0 for i in old if left[i]}
        back: dict[tuple[str, int], tuple[str, int]] = {}
        changed = True
        while changed:
            changed = False
            for i in old:
                if ("o", i) not in dist:
                    continue
                for j in new:
                    d = dist["o", i] + cost(i, j)
                    if d < dist.get(("n", j), 1 << 60):
                        dist["n", j], back["n", j], changed = d, ("o", i), True
            for (i, j), sent in flow.items():
                if sent and ("n", j) in dist and (d := dist["n", j] - cost(i, j)) < dist.get(("o", i), 1 << 60):
                    dist["o", i], back["o", i], changed = d, ("n", j), True
        end = min((j for j in new if room[j] and ("n", j) in dist), key=lambda j: (dist["n", j], j))
        path, node = [], ("n", end)
        while node in back:
            path.append((back[node], node))
            node = back[node]
        amount = min([left[node[1]], room[end], *[flow[b[1], a[1]] for a, b in path if a[0] == "n"]])
        for a, b in path:
            edge, sign = ((a[1], b[1]), 1) if a[0] == "o" else ((b[1], a[1]), -1)
            flow[edge] = flow.get(edge, 0) + sign * amount
        left[node[1]] -= amount
        room[end] -= amount
    return {e: f for e, f in flow.items() if f}


def even(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def _table(df: DataFrame, rows: list[tuple], ddl: str) -> DataFrame:
    return F.broadcast(df.sparkSession.createDataFrame(rows, ddl))


def reshard(docs: DataFrame, old_shard: Column, old_shards: int, shards: int, keep: Sequence[str] | None = None) -> DataFrame:
    """Give every row a shard from 0 to ``shards - 1`` of near equal bytes, and a gapless slot in it.

    ``old_shard`` (0 to ``old_shards - 1``) tells where a row is now; a shard keeps its number.  The result has the columns of
    ``docs`` (or ``keep``) and ``OUTPUT``; ``moved`` is true for rows whose shard changes.  The law is ``bytes``.

    The size of a row is the UTF-8 bytes of its text plus 1 (null: 1; its checksum is that of no bytes).  The flow between old sizes and
    new capacities says how many bytes leave each shard and where to.  An old shard is laid out by falling size, so that
    the stretches end between small rows; equal texts lie together and stay together, unless they exceed ``WHOLE`` of
    a shard.  An empty table gives an empty table; repeated rows are rows of their own; columns named as in ``OUTPUT`` are replaced.
    """
    docs = without(docs, *OUTPUT) if keep is None else docs
    columns = docs.columns if keep is None else list(keep)
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.withColumns(
        {
            "size": (F.octet_length(body) + 1).cast("long"),
            "text_crc32": F.crc32(body),
            "__old": F.coalesce(old_shard.cast("int"), F.lit(0)),
            "__print": F.xxhash64(F.coalesce("text", F.lit(""))),
            "__one": F.lit(1).cast("long"),
        }
    )
    extra = ["size", "text_crc32", "__old", "__print", "__one"]
    rows = rows.select(*quoted(list(dict.fromkeys([*columns, "doc_id"]))), *extra)
    order = [F.col("__old"), F.col("size").desc(), F.col("__print"), F.col("doc_id")]
    laid = running(rows, order, {"__at": "size", "__row": "__one"}, "laid")

    # from here to the segments: a row for each old shard, or for each pair of shards
    sums = {r["__old"]: r for r in laid.groupBy("__old").agg(F.sum("size").alias("n"), F.min("__at").alias("start")).collect()}
    supply = [sums[i]["n"] if i in sums else 0 for i in range(old_shards)]
    start = [sums[i]["start"] if i in sums else 0 for i in range(old_shards)]
    capacity = even(sum(supply), shards)
    flow = min_cost_flow(supply, capacity, lambda i, j: int(i != j))

    cuts, segments = [], []
    for i in range(old_shards):
        at = start[i]
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (j != i, j)):
            segments.append([i, j, at, at + flow[i, j]])
            at += flow[i, j]
            cuts.append(at)
    for segment, (a, b) in zip(segments, _snapped(laid, segments, WHOLE * min(capacity, default=0)), strict=True):
        segment[2:] = [a, b]

    ends = _table(laid, [tuple(s) for s in segments if s[2] < s[3]], "__i int, __j int, __a bigint, __b bigint")
    inside = (F.col("__old") == F.col("__i")) & (F.col("__at") >= F.col("__a")) & (F.col("__at") < F.col("__b"))
    placed = laid.join(ends, inside)
    counts = placed.groupBy("__j", "__a").agg(F.count("*").alias("n"), F.min("__row").alias("first")).collect()
    offsets, at = [], dict.fromkeys(range(shards), 0)
    for r in sorted(counts, key=lambda r: (r["__j"], r["__a"])):
        offsets.append((r["__a"], at[r["__j"]] - r["first"]))
        at[r["__j"]] += r["n"]
    moved_by = _table(laid, offsets, "__from bigint, __by bigint")
    return placed.join(moved_by, F.col("__a") == F.col("__from")).select(
        *quoted(columns),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("__j").alias("shard"),
        (F.col("__row") + F.col("__by")).alias("slot"),
        (F.col("__i") != F.col("__j")).alias("moved"),
    )


def _snapped(laid: DataFrame, segments: list[list[int]], whole: float) -> list[tuple[int, int]]:
    """The segments with their ends moved to an edge of the group of equal texts that they fall into.

    A group of more than ``whole`` bytes is cut at the nearer edge of the row.  At most one row for each cut is collected.
    """
    cuts = {(i, b) for i, _, _, b in segments}
    ends = _table(laid, sorted(cuts), "__i int, __cut bigint")
    across = (F.col("__old") == F.col("__i")) & (F.col("__at") < F.col("__cut")) & (F.col("__at") + F.col("size") > F.col("__cut"))
    rows = laid.join(ends, across).select("__i", "__cut", "__at", "size", "__print").collect()
    keys = _table(laid, [(r["__i"], r["size"], r["__print"], r["__cut"]) for r in rows], "__i int, __s bigint, __p bigint, __cut bigint")
    same = (F.col("__old") == F.col("__i")) & (F.col("size") == F.col("__s")) & (F.col("__print") == F.col("__p"))
    groups: dict[int, Row] = {
        r["__cut"]: r
        for r in laid.join(keys, same).groupBy("__cut").agg(F.min("__at").alias("a"), F.max(F.col("__at") + F.col("size")).alias("b")).collect()
    }
    to = {}
    for r in rows:
        g, cut = groups[r["__cut"]], r["__cut"]
        edges = (g["a"], g["b"]) if g["b"] - g["a"] <= whole else (r["__at"], r["__at"] + r["size"])
        to[cut] = min(edges, key=lambda e: (abs(e - cut), e))
    return [(to.get(a, a), to.get(b, b)) for _, _, a, b in segments]


def rewrite(assigned: DataFrame, path: str, mode: str = "overwrite") -> list[int]:
    """Write the shards that gain or lose rows, one folder each, rows by slot; the other shards' files stay as they are.

    ``assigned`` is the result of ``reshard`` with the old shard as a column ``old_shard``; it must not be read from ``path`` itself.  The
    folders of shards that lose all their rows are removed after the write.  The result is the list of the shards written or removed.
    """
    changed = assigned.filter("moved")
    # as many rows as shards
    touched = changed.select("shard").union(changed.select(F.col("old_shard").alias("shard"))).distinct()
    touched = sorted(r["shard"] for r in touched.collect())
    if not touched:
        return []
    rows = assigned.filter(F.col("shard").isin(touched))
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode(mode).option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)
    spark = assigned.sparkSession
    filled = {r["shard"] for r in rows.select("shard").distinct().collect()}
    for shard in touched:
        if shard not in filled:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return touched


def rewritten(assigned: DataFrame, path: str) -> DataFrame:
    """``assigned`` as it is after ``rewrite`` to ``path``, a folder without the old layout: the rows of changed shards are read back from there."""
    touched = rewrite(assigned, path)
    if not touched:
        return assigned
    same = assigned.filter(~F.col("shard").isin(touched))
    return assigned.sparkSession.read.schema(assigned.schema).parquet(path).select(*quoted(assigned.columns)).unionByName(same)
