"""Language by cross-parsing: the language whose text needs the fewest phrases to spell a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, without

# Bounds of the training text: characters of each language, and of each document in it.
TRAIN_CHARS = 20_000
DOC_CHARS = 2_000
# Most letters of a language whose parsing table has a column for each; that of more letters is sparse.
LETTERS = 64
# Documents are parsed in pieces of so many characters, all pieces of a batch side by side.
PIECE = 512
BATCH_CHARS = 4_000_000

BLANK, OTHER = 0, 1
OUTPUT = ("lang_pred", "score")


def _ways(text: list[int]) -> list[dict[int, int]]:
    """The suffix automaton of the text: the next state by letter for each state, the root first."""
    ways: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        ways.append({})
        length.append(length[last] + 1)
        link.append(0)
        new, p = len(ways) - 1, last
        while p >= 0 and c not in ways[p]:
            ways[p][c] = new
            p = link[p]
        if p >= 0:
            q = ways[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                ways.append(dict(ways[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                copy = len(ways) - 1
                while p >= 0 and ways[p].get(c) == q:
                    ways[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return ways


def suffix_automaton(text: list[int], letters: int) -> np.ndarray:
    """Parsing table of the text's suffix automaton: for a state and a letter, twice the next state, plus 1 if a phrase begins.

    The automaton follows exactly the substrings of the text.  Where a state has no way on for a letter, the next phrase
    begins with that letter, so each entry has the step from the root in it.  The last state is the one before
    any phrase, and after a letter that the text has nowhere, which is a phrase of its own.
    """
    ways = _ways(text)
    table = np.full((len(ways) + 1, letters), 2 * len(ways) + 1, np.int32)
    for c, to in ways[0].items():
        table[:, c] = 2 * to + 1
    for state, out in enumerate(ways):
        for c, to in out.items():
            table[state, c] = 2 * to
    return table


class Parser:
    """Parsing table over the letters of one language's text: dense if they are few, else the automaton's ways by sorted keys."""

    def __init__(self, coded: np.ndarray, codes: int):
        seen = np.unique(coded)
        self.letters = len(seen) + 1
        # column 0 is for letters that the text has nowhere
        self.column = np.zeros(codes, np.min_scalar_type(self.letters))
        self.column[seen] = np.arange(1, self.letters)
        text = self.column[coded].tolist()
        self.dense = self.letters <= LETTERS
        if self.dense:
            table = suffix_automaton(text, self.letters)
            self.start, self.steps = len(table) - 1, table.reshape(-1)
            return
        ways = _ways(text)
        self.start = len(ways)
        found = sorted((state * self.letters + c, 2 * to) for state, out in enumerate(ways) for c, to in out.items())
        self.keys, self.steps = np.array([k for k, _ in found], np.int64), np.array([v for _, v in found], np.int32)
        self.first = np.full(self.letters, 2 * self.start + 1, np.int32)
        for c, to in ways[0].items():
            self.first[c] = 2 * to + 1

    def step(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        """As an entry of ``suffix_automaton``, for each state and column."""
        at = state * self.letters + column
        if self.dense:
            return self.steps[at]
        i = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return np.where(self.keys[i] == at, self.steps[i], self.first[column])


class Model:
    """The parsing tables of all languages over one alphabet; its size is bounded by the training bounds."""

    def __init__(self, languages: list[str], code: np.ndarray, tables: list[Parser], bits: np.ndarray):
        self.languages, self.code, self.tables, self.bits = languages, code, tables, bits

    @classmethod
    def of(cls, texts: dict[str, str]) -> Model:
        languages = sorted(texts)
        letters = sorted({c for text in texts.values() for c in plain(text) if c.isalpha()})
        code = np.full(0x110000, OTHER, np.min_scalar_type(len(letters) + 2))
        code[[i for i in range(len(code)) if not chr(i).isalpha()]] = BLANK
        for i, c in enumerate(letters):
            code[ord(c)] = i + 2
        model = cls(languages, code, [], np.zeros(0))
        coded = [model.codes(texts[x]) for x in languages]
        model.tables = [Parser(c, len(letters) + 2) for c in coded]
        # bits to name a place in the training text: a language with more of it has longer phrases, but dearer ones
        model.bits = np.log2([len(c) + 2 for c in coded])
        return model

    def codes(self, text: str) -> np.ndarray:
        out = self.code[np.frombuffer(plain(text).encode("utf-32-le", "surrogatepass"), np.uint32)]
        # runs of what is no letter are one blank
        return out[np.append(True, (out[1:] != BLANK) | (out[:-1] != BLANK))[: len(out)]]

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """Phrases that each text needs in each language, as an array of texts by languages."""
        n = [-(-len(c) // PIECE) for c in coded]
        owner = np.repeat(np.arange(len(coded)), n)
        out = np.zeros((len(coded), len(self.tables)))
        if not len(owner):
            return out
        cut = np.concatenate([np.minimum(PIECE, len(c) - PIECE * np.arange(k)) for c, k in zip(coded, n, strict=True)])
        order = np.argsort(-cut, kind="stable")  # longest first: what still runs is always the front
        lanes = np.zeros((PIECE, len(owner)), self.code.dtype)
        at = 0
        for c, k in zip(coded, n, strict=True):
            padded = np.zeros(k * PIECE, self.code.dtype)
            padded[: len(c)] = c
            lanes[:, at : at + k] = padded.reshape(k, PIECE).T
            at += k
        lanes, cut, owner = lanes[:, order], cut[order], owner[order]
        running = np.searchsorted(-cut, -np.arange(PIECE), side="left")
        # the lanes of the pieces before and after, or -1
        lane = np.empty_like(order)
        lane[order] = np.arange(len(order))
        before, after = np.full(len(order), -1), np.full(len(order), -1)
        same = np.flatnonzero(owner[lane[1:]] == owner[lane[:-1]])
        before[lane[same + 1]], after[lane[same]] = lane[same], lane[same + 1]
        for x, parser in enumerate(self.tables):
            columns = parser.column[lanes]
            steps = np.zeros(lanes.shape, np.int32)
            state = np.full(len(owner), parser.start, np.int64)
            for i in range(int(cut.max())):
                m = running[i]
                steps[i, :m] = parser.step(state[:m], columns[i, :m])
                state[:m] = steps[i, :m] >> 1
            self._joined(parser, columns, steps, cut, before, after)
            out[:, x] = np.bincount(owner, weights=(steps & 1).sum(axis=0), minlength=len(coded))
        return out

    @staticmethod
    def _joined(parser: Parser, columns: np.ndarray, steps: np.ndarray, cut: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
        """Parse each piece again from where the one before it ends, as far as that changes its states; then ``steps`` are those of whole texts."""
        again = np.flatnonzero(before >= 0)
        while len(again):
            live, state, changed = again, (steps[PIECE - 1, before[again]] >> 1).astype(np.int64), again[:0]
            for i in range(PIECE):
                new = parser.step(state, columns[i, live])
                differs = (new >> 1) != (steps[i, live] >> 1)
                steps[i, live] = new
                if i == PIECE - 1:
                    changed = live[differs]
                on = differs & (cut[live] > i + 1)
                live, state = live[on], (new[on] >> 1).astype(np.int64)
                if not len(live):
                    break
            again = after[changed]
            again = again[again >= 0]


def plain(text: str) -> str:
    return text.lower()


def training_text(docs: DataFrame, chars: int = TRAIN_CHARS) -> dict[str, str]:
    """At most ``chars`` characters of each language, from documents in the order of a hash of their id and text.

    A document gives at most DOC_CHARS from a place that its hash chooses; the number of documents is cut by
    their hash in the plan, so that what comes to the driver has a bound of languages x characters.
    """
    rows = docs.filter("lang IS NOT NULL AND length(text) > 0").select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("print"), F.length("text").alias("n")
    )
    given = F.least("n", F.lit(DOC_CHARS))
    sums = rows.groupBy("lang").agg(F.sum(given).alias("all")).withColumnRenamed("lang", "of")
    # about three times what is needed, evenly over the hashes
    part = F.least(F.lit(1.0), F.lit(3.0 * chars) / F.col("all")) * 1_000_000
    drawn = rows.join(F.broadcast(sums), F.col("lang") == F.col("of"))
    drawn = drawn.filter(F.pmod("print", F.lit(1_000_000)) < part)
    place = F.pmod(F.shiftright("print", 20), F.col("n") - given + 1) + 1
    piece = F.substring("text", place.cast("int"), given.cast("int"))
    out: dict[str, list[str]] = {}
    for row in drawn.select("lang", "print", piece.alias("piece")).orderBy("lang", "print").collect():
        have = out.setdefault(row["lang"], [])
        left = chars - sum(map(len, have))
        if left > 0:
            have.append(row["piece"][:left])
    return {lang: " ".join(pieces) for lang, pieces in out.items()}


def identify(docs: DataFrame, train: DataFrame) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to ``docs``, learnt from ``train`` (``doc_id, text, lang``).

    The whole text is lower-cased; a run of anything but letters is one blank.  For each language the text is cut
    greedily into the longest phrases that occur in its training text.  A phrase counts as the bits that name a place in that
    text; the language with the fewest bits wins, the first by name at a tie.  ``score`` is the weight of the winner
    in a softmax over bits by the root of the length, 0 to 1.

    A text that is null or has no letter gets ``und`` with score 0, and so does every text if nothing can be
    learnt.  Rows with null text or lang teach nothing.  Repeated rows are predicted alike; an empty table gives an empty
    table.  Columns of ``docs`` named as in ``OUTPUT`` are replaced.
    """
    spark = docs.sparkSession
    docs = without(docs, *OUTPUT)
    trained = Model.of(training_text(train))
    parts = spark.sparkContext.broadcast((trained.languages, trained.code, trained.tables, trained.bits))
    names = docs.columns
    at = names.index(next(c for c in names if c.lower() == "text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*parts.value)
        for batch in batches:
            texts, langs, scores = batch.column(at), [], []
            coded: list[np.ndarray] = []
            size = 0

            def settle(coded: list[np.ndarray], langs=langs, scores=scores) -> None:
                for c, p in zip(coded, m.phrases(coded) * m.bits, strict=True):
                    letters = int((c != BLANK).sum())
                    if not letters or not m.languages:
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    best = int(np.argmin(p))
                    beyond = np.minimum((p - p[best]) / np.sqrt(len(c)), 500)
                    langs.append(m.languages[best])
                    scores.append(float(1 / np.exp2(-beyond).sum()))

            for i in range(batch.num_rows):
                coded.append(m.codes(texts[i].as_py() or ""))
                size += len(coded[-1])
                if size >= BATCH_CHARS:
                    settle(coded)
                    coded, size = [], 0
            settle(coded)
            yield pa.RecordBatch.from_arrays(
                [*[c for i, c in enumerate(batch.columns) if i != at], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*[n for i, n in enumerate(names) if i != at], *OUTPUT],
            )

    fields = [f for i, f in enumerate(docs.schema.fields) if i != at]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["lang_pred string", "score double"])
    return docs.select(*quoted(names)).mapInArrow(predict, schema)
