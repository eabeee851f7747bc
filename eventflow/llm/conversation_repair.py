"""Repair of the structure of conversations by iterative-deepening A*.

A repaired conversation has the roles ``(s?(ua)+)?``: perhaps a system row, then user and assistant in turn.  Each row is kept,
given another role or deleted, and empty rows can be put anywhere; the cheapest edits win, and of equally cheap ones the
string of their initials that is least in ASCII order.  ``plans`` finds the edits from narrow rows (no texts), ``repaired``
applies them to the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions

# What the edits cost; a truncated row that stays costs more.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 4, 3, 0, 3, 3
# States by the last role (nothing, system, user, assistant) and where a role's initial leads from each.
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
# The state that an inserted row or a new role leads to, and that role.
WANTED = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# What a whole conversation that ends in a state still costs.
ENDING = (0, 2 * INSERT, INSERT, 0)
# A conversation is cut into at most so many blocks for the estimates, of so many rows at least.
BLOCKS, BLOCK_ROWS = 32, 4

PLAN = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)
REPAIRED = "conv_id bigint, place bigint, edit string, role string, text string"


def estimates(initials: str, faults: str) -> list[list[int]]:
    """A lower bound of what the rows from each place on cost, from each state.

    Additive over blocks of rows: inside a block the bound is exact, and where a block ends it goes on from the state that
    is cheapest for the rest, whichever state that is.
    """
    n = len(initials)
    size = max(BLOCK_ROWS, -(-n // BLOCKS))
    bounds = [list(ENDING)] * (n + 1)
    after = list(ENDING)
    for i in range(n - 1, -1, -1):
        if (i + 1) % size == 0 and i + 1 < n:
            after = [min(after)] * 4
        fault, initial = faults[i], initials[i]
        now = [DELETE + cost for cost in after]
        if fault not in "bd":
            more = TRUNCATED if fault == "t" else 0
            for state in range(4):
                stays = [REROLE + after[WANTED[state]]]
                if initial in LEGAL[state]:
                    stays.append(KEEP + after[LEGAL[state][initial]])
                now[state] = min(now[state], more + min(stays))
        for _ in range(2):  # more than two rows put in one place never pay
            now = [min(now[state], INSERT + now[WANTED[state]]) for state in range(4)]
        bounds[i] = after = now
    return [list(b) for b in bounds]


def cheapest_edits(initials: str, faults: str) -> tuple[int, str]:
    """The least cost, and the initials of the edits (Delete, Insert, Keep, Rerole) in order.

    ``initials`` has the first character of each row's role, ``faults`` one of ``b`` (blank), ``d`` (duplicate), ``t``
    (truncated) or ``-`` for each row.  Depth-first searches in ASCII order of the edits, each under the least cost that
    the one before has shown to be needed.  ``need`` is the table of failed states: what a state has been shown to
    need at least; a state with less left is not entered again, in this search or a later one.
    """
    n, need = len(initials), estimates(initials, faults)

    def edits(i: int, state: int) -> list[tuple[str, int, int, int]]:
        found = [("D", DELETE, i + 1, state)] if i < n else []
        found.append(("I", INSERT, i, WANTED[state]))
        if i < n and faults[i] not in "bd":
            more = TRUNCATED if faults[i] == "t" else 0
            if initials[i] in LEGAL[state]:
                found.append(("K", KEEP + more, i + 1, LEGAL[state][initials[i]]))
            found.append(("R", REROLE + more, i + 1, WANTED[state]))
        return found

    while True:
        bound = need[0][START]
        # a frame: place, state, what is left to spend, the edits, the next of them, the least that the tried ones need
        stack, path = [[0, START, bound, edits(0, START), 0, None]], []
        while stack:
            frame = stack[-1]
            i, state, left, choices, at, least = frame
            if i == n and state in (START, ASSISTANT):
                return bound, "".join(path)
            if at == len(choices):
                need[i][state] = max(need[i][state], least)
                stack.pop()
                if path:
                    path.pop()
                continue
            letter, cost, to, then = choices[at]
            wanted = cost + need[to][then]
            if wanted > left:
                frame[4], frame[5] = at + 1, wanted if least is None else min(least, wanted)
            else:
                # when it fails, it needs more than is left, and the edit is passed over
                stack.append([to, then, left - cost, edits(to, then), 0, None])
                path.append(letter)


def _rows(conversations: DataFrame) -> DataFrame:
    """Rows with null role and text as one space, and a digest that tells rows with another role or text apart."""
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    of_row = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("digest", F.unhex(F.sha2(of_row, 256)))


def plans(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id: its faults and the cheapest repair.

    Columns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.  The rows of a conversation are taken by turn
    (nulls first), rows of the same turn by role and then by a digest of role and text, so repeated rows stand together.
    A null role or text is one space; rows without conv_id are one conversation.  A row counts for its first fault: blank (no
    character but white space), duplicate (role and text seen earlier), truncated (the last character that is not white
    space is none of ``.!?``).  ``gaps`` are turns missing between the first and the last, ``illegal`` pairs of neighbours with
    other initials than su, ua or au, ``cost`` and ``audit`` what the edits cost and their initials in order.  Other columns are not read; an
    empty table has no plans.

    A task streams whole conversations in order; of a row it has the role's initial and the digest, not the text.
    """
    text = F.col("text")
    fault = (
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "b").when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), "t").otherwise("-")
    )
    # role and turn are the order only; the search itself needs two characters a row
    narrow = _rows(conversations).select(
        "conv_id", "turn", "role", "digest", F.concat(fault, F.substring("role", 1, 1)).alias("seen")
    )
    ordered = narrow.repartition(partitions(narrow.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "digest"
    )
    columns = [name.split(" ")[0] for name in PLAN.split(", ")]

    def plan(key: int | None, turns: set[int | None], initials: list[str], faults: list[str]) -> dict:
        roles, marks = "".join(initials), "".join(faults)
        known = turns - {None}
        cost, audit = cheapest_edits(roles, marks)
        return {
            "conv_id": key,
            "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
            "blank": marks.count("b"),
            "duplicate": marks.count("d"),
            "truncated": marks.count("t"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost,
            "audit": audit,
        }

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns, initials, faults, before = None, None, [], [], set()
        for batch in batches:
            done = []
            for conv, turn, digest, seen in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "digest", "seen")], strict=True):
                if turns is None or conv != key:
                    if turns is not None:
                        done.append(plan(key, turns, initials, faults))
                    key, turns, initials, faults, before = conv, set(), [], [], set()
                turns.add(turn)
                # an empty role has no initial; a blank stands for it, which is legal nowhere
                initials.append(seen[1:] or " ")
                faults.append("d" if seen[0] != "b" and digest in before else seen[0])
                before.add(digest)
            if done:
                yield _batch(done, columns)
        if turns is not None:
            yield _batch([plan(key, turns, initials, faults)], columns)

    return ordered.mapInArrow(planned, PLAN)


def _batch(rows: list[dict], columns: list[str]) -> pa.RecordBatch:
    kinds = {name: pa.int64() for name in columns} | {name: pa.string() for name in ("audit", "edit", "role", "text", "sha256") if name in columns}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[c]) for c in columns], names=columns)


def repaired(conversations: DataFrame, planned: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: ``conv_id, place, edit, role, text``, whole conversations in order.

    ``planned`` is the result of ``plans`` for the same rows.  Each plan travels ahead of its conversation's rows, so a task holds
    one audit string and a batch of rows, however long the conversation.  A conversation without rows left has none.
    """
    rows = _rows(conversations).withColumn("is_row", F.lit(1))
    ahead = planned.select(
        "conv_id",
        F.lit(None).cast("bigint").alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).alias("is_row"),
    )
    both = rows.withColumn("turn", F.col("turn").cast("bigint")).unionByName(ahead)
    ordered = both.repartition(partitions(both.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "is_row", F.asc_nulls_first("turn"), "role", "digest"
    )
    columns = [name.split(" ")[0] for name in REPAIRED.split(", ")]

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, START, 0

        def inserted(key: int | None, out: list[dict]) -> None:
            nonlocal at, state, place
            while audit[at : at + 1] == "I":
                state = WANTED[state]
                out.append({"conv_id": key, "place": place, "edit": "I", "role": ROLE[state], "text": ""})
                at, place = at + 1, place + 1

        for batch in batches:
            out: list[dict] = []
            for key, is_row, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "is_row", "role", "text")], strict=True):
                if not is_row:
                    audit, at, state, place = text, 0, START, 0
                    inserted(key, out)
                    continue
                letter = audit[at]
                at += 1
                if letter != "D":
                    state = LEGAL[state][role[:1]] if letter == "K" else WANTED[state]
                    out.append({"conv_id": key, "place": place, "edit": letter, "role": role if letter == "K" else ROLE[state], "text": text})
                    place += 1
                inserted(key, out)
            if out:
                yield _batch(out, columns)

    return ordered.select("conv_id", "is_row", "role", "text").mapInArrow(replay, REPAIRED)


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the repaired rows as ``role:text``, joined by newlines; ``rows`` as ``repaired`` returns them."""
    columns = ["conv_id", "sha256"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done = []
            for conv, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")], strict=True):
                if place == 0:
                    if sha is not None:
                        done.append({"conv_id": key, "sha256": sha.hexdigest()})
                    key, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if done:
                yield _batch(done, columns)
        if sha is not None:
            yield _batch([{"conv_id": key, "sha256": sha.hexdigest()}], columns)

    return rows.mapInArrow(digest, "conv_id bigint, sha256 string")


# What the damage does, by the remainder of a checksum.
DROP, EMPTY, UNFINISH, REPEAT, USER_ROLE = range(5)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, by ``crc32(conv_id:turn) % 20``; nulls in role, text and the key are one space.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes it a user's.
    """

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(known("conv_id"), F.lit(":"), known("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("kind"))
    changed = rows.filter(F.col("kind") != DROP).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == USER_ROLE, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == EMPTY, "").when(F.col("kind") == UNFINISH, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        "kind",
    )
    times = F.when(F.col("kind") == REPEAT, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return changed.withColumn("__time", F.explode(times)).select("conv_id", "turn", "role", "text")
