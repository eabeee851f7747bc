"""Chat formatting: a finite-state machine over the roles, and text segments with loss flags from a declarative template.

Only SQL functions.  A template lists, for each role, what stands before and after its text, whether the loss covers the text,
and which roles may come next.  Control strings inside texts are escaped, so the formatted text can be read back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How one role is written; ``after`` has the roles that may stand before it, None for the start."""

    role: str
    opens: str
    closes: str
    loss: bool = False
    after: tuple[str | None, ...] = ()


@dataclass(frozen=True)
class Template:
    """``turns`` by role; any other role is written as its name between ``opens`` and ``says`` and is never legal.

    ``names`` are the words of control strings: any ``[NAME]``, ``[/NAME]``, ``<NAME>`` or ``</NAME>`` is one.  Each marker
    holds exactly one, apart from blanks around it.  ``ends`` are the roles that a conversation may end with.
    """

    turns: tuple[Turn, ...]
    names: tuple[str, ...]
    ends: tuple[str, ...]
    opens: str = "[ROLE] "
    says: str = " [SAYS] "
    closes: str = " [/ROLE]"

    def control(self, escapes: str) -> str:
        """Pattern of a control string with ``escapes`` after its bracket."""
        names = "|".join(self.names)
        return rf"([\[<]){escapes}(?=/?(?:{names})[\]>])"


TEMPLATE = Template(
    turns=(
        Turn("system", "[SYS] ", " [/SYS]", after=(None,)),
        Turn("user", "[INST] ", " [/INST]", after=(None, "system", "assistant")),
        Turn("assistant", "<s> ", " </s>", loss=True, after=("user",)),
    ),
    names=("s", "SYS", "INST", "ROLE", "SAYS"),
    ends=("assistant",),
)


def escaped(text: Column, template: Template = TEMPLATE) -> Column:
    """One more backslash after the bracket of each control string, however many stand there already."""
    return F.regexp_replace(text, template.control(r"(\\*)"), r"$1\\$2")


def unescaped(text: Column, template: Template = TEMPLATE) -> Column:
    """The inverse of ``escaped``."""
    return F.regexp_replace(text, template.control(r"\\(\\*)"), "$1$2")


def _machine(template: Template) -> Column:
    """``{state before|role: true}`` of the legal steps; a state is the last role, the empty string at the start."""
    steps = [f"{before or ''}|{turn.role}" for turn in template.turns for before in turn.after]
    return F.array(*[F.lit(s) for s in steps])


def formatted(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row for each conv_id: ``conv_id, n_turns, valid, first_bad, segments, formatted``.

    The turns are taken by turn (nulls first), then role and text; repeated rows are turns of their own.  A null role or text is
    empty, rows without conv_id are one conversation, other columns are not read, an empty table has no rows.  The machine
    goes over the roles: ``first_bad`` is the place of the first turn that may not stand there (the number of turns where only the
    end is wrong), null if ``valid``.  Conversations that it rejects are formatted all the same.  ``segments`` is an array of
    ``text, loss``, and ``formatted`` joins their texts.

    A row of the result is a whole conversation, and so is what a task holds at a time.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    legal, n = _machine(template), F.size("turns")
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(at: Column, turn: Column) -> Column:
        good = F.array_contains(legal, F.concat(at["state"], F.lit("|"), turn["role"]))
        bad = F.coalesce(at["bad"], F.when(~good, at["at"]))
        return F.struct(turn["role"].alias("state"), (at["at"] + 1).alias("at"), bad.alias("bad"))

    def end(at: Column) -> Column:
        return F.coalesce(at["bad"], F.when(~at["state"].isin(*template.ends), at["at"]))

    def segment(text: Column | str, loss: bool) -> Column:
        return F.struct((F.lit(text) if isinstance(text, str) else text).alias("text"), F.lit(loss).alias("loss"))

    def written(turn: Column) -> Column:
        other = F.array(
            segment(F.concat(F.lit(template.opens), escaped(turn["role"], template), F.lit(template.says)), False),
            segment(escaped(turn["text"], template), False),
            segment(template.closes, False),
        )
        for known in reversed(template.turns):
            as_known = F.array(segment(known.opens, False), segment(escaped(turn["text"], template), known.loss), segment(known.closes, False))
            other = F.when(turn["role"] == known.role, as_known).otherwise(other)
        return other

    done = whole.select(
        "conv_id",
        n.cast("bigint").alias("n_turns"),
        F.aggregate("turns", start, step, end).cast("bigint").alias("first_bad"),
        F.flatten(F.transform("turns", written)).alias("segments"),
    )
    return done.select(
        "conv_id",
        "n_turns",
        F.col("first_bad").isNull().alias("valid"),
        "first_bad",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def _literal(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c not in " <>/" else c for c in text)


def read_back(text: Column, template: Template = TEMPLATE) -> Column:
    """Array of ``role, text``: the turns of a formatted conversation."""
    markers = [(t.opens, t.closes) for t in template.turns] + [(template.opens, template.closes)]
    # an escaped control string is none, so the first closing marker of its kind ends the turn
    pattern = "(?s)" + "|".join(f"{_literal(a)}.*?{_literal(b)}" for a, b in markers)

    def turn(piece: Column) -> Column:
        says = F.instr(piece, F.lit(template.says))
        first = F.length(F.lit(template.opens))
        role = F.substring(piece, first + 1, says - 1 - first)
        said = says + len(template.says)
        other = F.struct(
            unescaped(role, template).alias("role"),
            unescaped(F.substring(piece, said, F.length(piece) - said + 1 - len(template.closes)), template).alias("text"),
        )
        for known in reversed(template.turns):
            a, b = len(known.opens), len(known.closes)
            inner = F.substring(piece, F.lit(a + 1), F.length(piece) - a - b)
            as_known = F.struct(F.lit(known.role).alias("role"), unescaped(inner, template).alias("text"))
            other = F.when(F.startswith(piece, F.lit(known.opens)), as_known).otherwise(other)
        return other

    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), turn)


def under_loss(segments: Column, template: Template = TEMPLATE) -> Column:
    """The unescaped text that the loss covers, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")
