"""Conversation repair, chat formatting and periodic runs: brute force, SQL and odd rows."""

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm import queries as Q
from eventflow.llm.chat_format import TEMPLATE, Template, Turn, escaped, formatted, read_back, under_loss, unescaped
from eventflow.llm.conversation_repair import cheapest_edits, damaged, digests, estimates, plans, repaired
from eventflow.llm.periodic_runs import kept_words, may_repeat, periodic_runs, planted, runs_of

sys.path.insert(0, str(Path(__file__).parent.parent))
from oracle_check import compare, connect  # noqa: E402

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id bigint, turn bigint, role string, text string, cost string, `n turns` int, formatted int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, 0, "system", "Be kind."),
        (1, 1, "user", "Hello."),
        (1, 1, "user", "Hello."),
        (1, 2, "assistant", "Hi."),
        (2, None, None, None),
        (2, None, "user", ""),
        (2, 5, "assistant", "long text " * 100_000 + "ends."),
        (3, 9, "", "no role"),
        (None, 1, "user", "Nobody's?"),
        (None, 2, "assistant", "[/INST] [\\INST] </s> [SAYS] [ROLE]"),
        (4, 3, "tool [SAYS] x\n", " [/ROLE] Ünïcode 😀 "),
        (4, 4, "assistant", "a. "),
        (5, -(2**62), "user", "Early."),
        (5, 3, "assistant", "Late."),
    ]
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], TURNS).repartition(3)


# op11


def by_rows(initials, faults):
    """The least cost and edits, state by state from the front."""
    wanted, legal = (2, 2, 3, 2), ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})

    def put(into, state, path):
        into[state] = min(into.get(state, path), path)

    def with_inserts(best):
        for _ in range(3):
            for state, (cost, edits) in list(best.items()):
                put(best, wanted[state], (cost + 3, edits + "I"))
        return best

    best = {0: (0, "")}
    for initial, fault in zip(initials, faults, strict=True):
        after = {}
        for state, (cost, edits) in with_inserts(best).items():
            put(after, state, (cost + 4, edits + "D"))
            if fault in "-t":
                more = cost + 3 * (fault == "t")
                if initial in legal[state]:
                    put(after, legal[state][initial], (more, edits + "K"))
                put(after, wanted[state], (more + 3, edits + "R"))
        best = after
    best = with_inserts(best)
    return min(best[state] for state in (0, 3) if state in best)


def test_search_finds_the_least_edits():
    rng = random.Random(1)
    for _ in range(5000):
        n = rng.randrange(14)
        initials, faults = "".join(rng.choices("suaaut ", k=n)), "".join(rng.choices("--tbd", k=n))
        got = cheapest_edits(initials, faults)
        assert got == by_rows(initials, faults)
        assert estimates(initials, faults)[0][0] <= got[0]
    initials, faults = "".join(rng.choices("suaau", k=3000)), "".join(rng.choices("----tbd", k=3000))
    assert cheapest_edits(initials, faults) == by_rows(initials, faults)


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_chat_format"])
def test_conversations_against_sql(spark, sf, name):
    assert compare(spark, connect(sf), name, Q.QUERIES[name], Q.ORACLES[name], sf) is None


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_chat_format"])
def test_odd_conversations_against_sql(spark, odd, name, tmp_path):
    odd.select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert compare(spark, con, name, Q.QUERIES[name], Q.ORACLES[name], str(tmp_path)) is None


def test_damage_and_repair_of_each_kind(spark, odd):
    kinds = {zlib.crc32(f"{c}:{t}".encode()) % 20 for c in range(40) for t in range(3)}
    assert {0, 1, 2, 3, 4} <= kinds
    rows = [(c, t, "assistant" if t else "user", "Is it? Yes!") for c in range(40) for t in range(3)]
    got = {}
    for r in damaged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        want = {0: [], 1: [(role, "")], 2: [(role, "Is it Yes")], 3: [(role, text)] * 2, 4: [("user", text)]}.get(kind, [(role, text)])
        assert got.get((c, t), []) == want
    planned = plans(odd).cache()
    by_id = {r.conv_id: r for r in planned.collect()}
    assert set(by_id) == {1, 2, 3, 4, 5, None}
    assert by_id[1].audit == "KKDK" and by_id[1].duplicate == 1 and by_id[1].cost == 4 and by_id[1].gaps == 0
    # ties go to the string least in ASCII order, and a white space of Unicode is a character
    assert by_id[4].truncated == 2 and by_id[2].blank == 2 and by_id[5].gaps == 2**62 + 2
    rows = repaired(odd, planned)
    out = {}
    for r in rows.collect():
        out.setdefault(r.conv_id, []).append(r)
    for key, made in out.items():
        made.sort(key=lambda r: r.place)
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in made)), key
        assert [r.place for r in made] == list(range(len(made)))
        assert "".join(r.edit for r in made) == by_id[key].audit.replace("D", "")
    sums = {r.conv_id: r.sha256 for r in digests(rows).collect()}
    for key, made in out.items():
        assert sums[key] == hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in made).encode()).hexdigest()


def test_no_conversations(spark, odd):
    nothing = odd.limit(0)
    assert plans(nothing).collect() == [] and repaired(nothing, plans(nothing)).collect() == [] and formatted(nothing).collect() == []


# op12


def test_control_strings_come_back(spark):
    rng = random.Random(2)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "[\\INST]", "[\\\\/INST]", "\\", "[", "<", "/", "]", " ", "\n", "SAYS", "[SAYS]", "é", "😀", "$1"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not re.search(r"[\[<]/?(?:s|SYS|INST|ROLE|SAYS)[\]>]", r.e)
    roles = ["system", "user", "assistant", "tool", "", "[SAYS]", " [/ROLE]", None]
    rows = [(i // 7, i % 7, rng.choice(roles), t) for i, t in enumerate(texts)]
    done = formatted(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    for r in done.select("*", read_back(F.col("formatted")).alias("back"), under_loss(F.col("segments")).alias("loss")).collect():
        turns = [(role or "", text) for c, _, role, text in rows if c == r.conv_id]
        assert [(b.role, b.text) for b in r.back] == turns
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments) and r.n_turns == len(turns)


def test_machine_over_roles(spark):
    cases = {"sua": None, "ua": None, "uaua": None, "suaua": None, "u": 1, "su": 2, "s": 1, "a": 0, "uu": 1, "uas": 2, "ssua": 1, "uax": 2, "x": 0, "uuaa": 1}
    role = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = [(i, t, role[c], "text") for i, roles in enumerate(cases) for t, c in enumerate(roles)]
    done = {r.conv_id: r for r in formatted(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    for i, (roles, bad) in enumerate(cases.items()):
        assert (done[i].valid, done[i].first_bad) == (bad is None, bad), roles
    assert done[0].formatted == "[SYS] text [/SYS][INST] text [/INST]<s> text </s>"
    assert [s.loss for s in done[0].segments] == [False] * 7 + [True, False]


def test_another_template(spark):
    other = Template((Turn("q", "[Q]", "[/Q]", after=(None, "r")), Turn("r", "[R]", "[/R]", True, ("q",))), ("Q", "R", "X", "Y"), ("r",), "[X]", "[Y]", "[/X]")
    rows = [(1, 0, "q", "[R] what"), (1, 1, "r", "[/R]"), (2, 0, "user", "[Y]")]
    done = formatted(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), other)
    got = {r.conv_id: r for r in done.select("*", read_back(F.col("formatted"), other).alias("back")).collect()}
    assert [tuple(b) for b in got[1].back] == [("q", "[R] what"), ("r", "[/R]")] and got[1].valid
    assert [tuple(b) for b in got[2].back] == [("user", "[Y]")] and not got[2].valid
    assert TEMPLATE.names != other.names


# op13


def runs_by_periods(words):
    """Every run, by comparing the sequence with itself moved by each period."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_random_sequences():
    rng, total = random.Random(3), 0
    for _ in range(6000):
        n, k = rng.randrange(60), rng.choice([1, 2, 3, 6])
        w = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // (3 + rng.randrange(8))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            w = w + [9] + w if rng.random() < 0.3 else w
        want = runs_by_periods(w)
        assert runs_of(np.array(w, np.int64)) == want
        assert not want or may_repeat(np.array(w, np.int64))
        total += len(want)
    assert total > 1000


def test_hot_sequences():
    rng = random.Random(4)
    assert runs_of(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    assert runs_of(np.arange(60_000) % 20) == [(0, 60_000, 20)]
    # a stretch that comes again thousands of times between other words, once in a row of five
    often = [w for i in range(4000) for w in (*range(8), 100 + rng.randrange(40_000))]
    often += [1, 2, 3] * 5 + often
    assert runs_of(np.array(often, np.int64)) == [(36_000, 15, 3)] and len(often) > 70_000


def test_periodic_runs_of_documents(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    hits = 0
    for r in Q.op13_periodic_runs(spark, sf).collect():
        words = WORDS.findall(docs[r.doc_id])
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:  # too long for the plain way
            continue
        runs = runs_by_periods(words)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = [w for i, w in enumerate(words) if i not in dropped]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()
        hits += bool(runs)
    assert hits > 5


def test_runs_in_odd_rows(spark):
    schema = "doc_id bigint, text string, Runs int, `a b` string, collapsed string"
    texts = [None, "", " \t\n ", "a a a a a a", "x\u00a0y " * 6, "A a " * 3, "la " * 30_000, "a a a a a a"]
    docs = spark.createDataFrame([(i or None, t, 1, "c", "d") for i, t in enumerate(texts)], schema).repartition(3)
    out = periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "a b", "runs", "collapsed"]
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in out.collect()}
    assert got == {
        None: ([], ""), 1: ([], ""), 2: ([], ""), 3: ([(0, 6, 1)], "a"), 4: ([(0, 6, 1)], "x\u00a0y"),
        5: ([], "A a A a A a"), 6: ([(0, 30_000, 1)], "la"), 7: ([(0, 6, 1)], "a"),
    }
    assert periodic_runs(docs.limit(0)).collect() == [] and planted(docs.limit(0)).collect() == []
    assert planted(docs).count() == len(texts)
    assert kept_words(8, [(0, 6, 1), (1, 6, 1)]).tolist() == [True] + [False] * 6 + [True]
