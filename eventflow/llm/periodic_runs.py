"""Runs of repeated words, by the maximal pairs of a text.

A run is a stretch of words with smallest period q, at least ``TIMES`` periods and ``LEAST`` words long, that no neighbouring word
extends.  A run of length L and period q is exactly a pair of equal stretches, q apart and L - q long, that neither side extends: a
maximal pair.  Suffixes in order, with the lengths of their common prefixes (LCP), give the tree of LCP intervals; bottom up, each
interval has the places of its stretch in lists by the word to their left.  Places of different children and different lists are
maximal pairs; only those near enough for their length are looked for, and each is a run as it stands.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import without
from .shingles import pieces

# A run has so many periods, and so many words, at least.
TIMES, LEAST = 4, 6
# The shortest stretch of a pair that can be a run: LEAST words less a period of one.
SHORTEST = LEAST - 1
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

# Odd factors that tell the places in a shingle apart.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """The suffixes of a sequence in order, by doubling the length that they are compared on."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    while step < 2 * n:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if rank[order[-1]] == n - 1:
            break
        step *= 2
    return order


def common_prefixes(codes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix in order, the length of the prefix it shares with the one before (0 for the first)."""
    n = len(codes)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    word, left, shared = memoryview(codes), memoryview(before), np.zeros(n, np.int64)
    into, length = memoryview(shared), 0
    for i in range(n):
        j = left[i]
        if j < 0:
            length = 0
            continue
        most = n - max(i, j)
        while length < most and word[i + length] == word[j + length]:
            length += 1
        into[i] = length
        length -= length > 0
    return shared[order]


class _Tree:
    """The LCP intervals of one text, bottom up; ``found`` has the runs by start and length.

    A node is ``[depth, lists, size]``: how long its stretch is, the places of the stretch in sorted lists by the word to their
    left, and their number.
    """

    def __init__(self, codes: np.ndarray):
        # the word to the left of each place; the text's first has one of its own
        self.left = memoryview(np.concatenate([[-1], codes]).astype(np.int64))
        self.found: dict[tuple[int, int], int] = {}

    def pair(self, i: int, j: int, depth: int) -> None:
        start, period = (i, j - i) if j > i else (j, i - j)
        if period + depth >= LEAST:
            # the run's start pairs with the ends of several periods too: the least is the run's
            self.found[start, depth + period] = min(self.found.get((start, depth + period), period), period)

    def absorb(self, node: list, lists: dict[int, list[int]], size: int) -> None:
        """Give a child's places to a node; the maximal pairs between them and the node's own are noted first."""
        depth, here, count = node
        near = depth // (TIMES - 1)
        if size > count:
            here, lists = lists, here
        for word, places in lists.items():
            if len(here) - (word in here) <= 2 * near:
                others = [other for left, other in here.items() if left != word]
                for i in places if others else ():
                    for other in others:
                        for at in range(bisect_left(other, i - near), bisect_right(other, i + near)):
                            self.pair(i, other[at], depth)
            else:
                # fewer places near than lists: look each place up in the list it would be in
                for i in places:
                    for j in range(max(0, i - near), min(i + near + 1, len(self.left) - 1)):
                        other = here.get(self.left[j]) if self.left[j] != word else None
                        if other and (at := bisect_left(other, j)) < len(other) and other[at] == j:
                            self.pair(i, j, depth)
        for word, places in lists.items():
            mine = here.get(word)
            if mine is None:
                here[word] = places
            elif mine[-1] < places[0]:
                mine.extend(places)
            elif len(places) * 16 < len(mine):
                for i in places:
                    insort(mine, i)
            else:
                mine.extend(places)
                mine.sort()
        node[1:] = here, count + size

    def close(self, stack: list[list], lists: dict[int, list[int]], size: int, depth: int) -> tuple[dict[int, list[int]], int]:
        """Finish the open intervals deeper than ``depth``, the last child first."""
        while stack and stack[-1][0] > depth:
            node = stack.pop()
            self.absorb(node, lists, size)
            _, lists, size = node
        return lists, size

    def walk(self, order: np.ndarray, shared: np.ndarray) -> None:
        """Go over the suffixes in order; only intervals of SHORTEST words or more are of use."""
        stack: list[list] = []
        at = np.flatnonzero(shared >= SHORTEST)
        last = -1
        for k, depth, place, before in zip(at.tolist(), shared[at].tolist(), order[at].tolist(), order[at - 1].tolist(), strict=True):
            if k != last + 1:
                if stack:
                    self.close(stack, lists, size, 0)
                lists, size = {self.left[before]: [before]}, 1
            lists, size = self.close(stack, lists, size, depth)
            if stack and stack[-1][0] == depth:
                self.absorb(stack[-1], lists, size)
            else:
                stack.append([depth, lists, size])
            lists, size, last = {self.left[place]: [place]}, 1, k
        if stack:
            self.close(stack, lists, size, 0)


def may_repeat(codes: np.ndarray) -> bool:
    """False only if no SHORTEST words in a row come again, in the way that a run needs.

    A run of period q has at least ``(TIMES - 1) * q - SHORTEST + 1`` places in a row, and one at least, whose next SHORTEST words come again within q.
    """
    n = len(codes)
    if n < LEAST:
        return False
    at = np.zeros(n - SHORTEST + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHORTEST):
            at += codes[k : n - SHORTEST + 1 + k].astype(np.uint64) * FACTORS[k]
    order = np.argsort(at, kind="stable")
    same = at[order[1:]] == at[order[:-1]]
    if not same.any():
        return False
    gap = np.full(len(at), n, np.int64)
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    within = 1
    while within < n:
        # periods from within / 2 up to within
        least = max(1, (TIMES - 1) * (within // 2 + 1) - SHORTEST + 1)
        away = np.flatnonzero(np.concatenate([[True], gap > within, [True]]))
        if (np.diff(away) - 1).max() >= least:
            return True
        within *= 2
    return False


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, length, period`` of every run of a sequence of non-negative integers, by start and period."""
    if not may_repeat(codes):
        return []
    tree, order = _Tree(codes), suffix_order(codes)
    tree.walk(order, common_prefixes(codes, order))
    return sorted(((start, length, period) for (start, length), period in tree.found.items()), key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The rows with ``runs`` (``start, length, period``, counted in words, by start and then period) and ``collapsed``.

    Words are ``[^\x20\x09-\x0D]+``.  ``collapsed`` has the words that no run contains after its first period, joined by one space.
    A null, empty or blank text has no runs and collapses to the empty text; repeated rows get equal results; columns that are
    called ``runs`` or ``collapsed`` are replaced, others stay; an empty table stays empty.  Each text is judged alone and whole, so
    rows need no shuffle; a task holds one text's suffixes at a time.
    """
    given = without(docs, "runs", "collapsed")
    kinds = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]
    schema = T.StructType([*given.schema.fields, *T.StructType.fromDDL(f"runs {RUNS}, collapsed string").fields])
    at = next((i for i, c in enumerate(given.columns) if c.lower() == "text"), None)

    def collapse(text: str | None) -> tuple[list[dict], str]:
        words = (text or "").encode().split()
        known: dict[bytes, int] = {}
        codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        runs = runs_of(codes)
        if runs:
            kept = kept_words(len(words), runs)
            words = [w for w, stays in zip(words, kept.tolist(), strict=True) if stays]
        return [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], b" ".join(words).decode()

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, at):
                done = [collapse(text) for text in piece.column(at).to_pylist()]
                new = [pa.array([r for r, _ in done], pa.list_(pa.struct(kinds))), pa.array([c for _, c in done], pa.string())]
                yield pa.RecordBatch.from_arrays([*piece.columns, *new], names=schema.names)

    return given.mapInArrow(collapsed, schema)


def planted(docs: DataFrame) -> DataFrame:
    """The documents, of which about a tenth get a periodic end: ``doc_id, text``, a null doc_id counting as empty text.

    With h the CRC-32 of the decimal doc_id, g = h div 10 and n words: where h mod 10 is 0, word i from a = g mod n on becomes word
    ``a + (i - a) mod p``, p = 1 + (n - a) div (3 + g mod 8).  Words are then joined by spaces.
    """
    h = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    start = chosen.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p")
    ready = start.select("doc_id", "text", "words", "n", F.col("a").cast("int").alias("a"), period.cast("int"))
    changed = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))),
    )
    return ready.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))
