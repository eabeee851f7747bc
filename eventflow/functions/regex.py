"""RE2-style patterns and replacement templates expressed for Spark's Java regex functions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# POSIX bracket names and their Java spelling.
POSIX_CLASSES = {
    "alnum": r"\p{Alnum}",
    "alpha": r"\p{Alpha}",
    "ascii": r"\p{ASCII}",
    "blank": r"\p{Blank}",
    "cntrl": r"\p{Cntrl}",
    "digit": r"\p{Digit}",
    "graph": r"\p{Graph}",
    "lower": r"\p{Lower}",
    "print": r"\p{Print}",
    "punct": r"\p{Punct}",
    "space": r"\s",
    "upper": r"\p{Upper}",
    "word": r"\w",
    "xdigit": r"\p{XDigit}",
}

_NAMED = re.compile(r"\(\?P?<([A-Za-z0-9_]+)>")
_FLAGS = re.compile(r"\(\?([imsU]*)(?:-([imsU]+))?([:)])")
_REPEAT = re.compile(r"\{\d+(?:,\d*)?\}")
_POSIX = re.compile(r"\[:(\^?)([a-z]+):\]")


class PatternError(ValueError):
    """The pattern is not valid in the RE2 dialect."""


@dataclass(frozen=True)
class Pattern:
    """A Java pattern whose named groups have become positional ones."""

    java: str
    names: tuple[tuple[int, str], ...]
    groups: int

    def index(self, name: str) -> int | None:
        return next((i for i, n in self.names if n == name), None)


def _escape(source: str, at: int, in_class: bool) -> tuple[str, int]:
    """Translate the backslash sequence at ``at``; returns the Java text and the next position."""
    if at + 1 >= len(source):
        raise PatternError("pattern ends with a backslash")
    ch = source[at + 1]
    if ch == "Q":
        end = source.find(r"\E", at)
        body = source[at + 2 : end if end >= 0 else len(source)]
        quoted = "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c for c in body)
        return quoted, (end + 2 if end >= 0 else len(source))
    if ch == "v":
        return r"\x0B", at + 2
    if ch in "123456789" or ch == "C":
        raise PatternError(f"unsupported escape \\{ch}")
    if ch in "pP":
        match = re.compile(r"\{(\^?)(\w+)\}").match(source, at + 2)
        if match:
            negate, name = match.groups()
            letter = ("P" if ch == "p" else "p") if negate else ch
            java = name if len(name) <= 2 else "Is" + name
            return f"\\{letter}{{{java}}}", match.end()
        return source[at : at + 3], at + 3
    return source[at : at + 2], at + 2


def _bracket(source: str, at: int) -> tuple[str, int]:
    """Translate the character class starting at ``at``."""
    out, pos = "[", at + 1
    if source[pos : pos + 1] == "^":
        out, pos = out + "^", pos + 1
    first = True
    while pos < len(source):
        ch = source[pos]
        if ch == "]" and not first:
            return out + "]", pos + 1
        posix = _POSIX.match(source, pos)
        if posix:
            negate, name = posix.groups()
            if name not in POSIX_CLASSES:
                raise PatternError(f"unknown character class {name}")
            body = POSIX_CLASSES[name]
            out += f"[^{body}]" if negate else body
            pos = posix.end()
        elif ch == "\\":
            piece, pos = _escape(source, pos, True)
            out += piece
        else:
            out += "\\" + ch if ch in "[]&" else ch
            pos += 1
        first = False
    raise PatternError("missing closing ]")


def compile_pattern(source: str) -> Pattern:
    """Java form of an RE2 pattern.

    ``$`` outside multi-line mode means end of text, ``.`` excludes only the newline, braces
    that are no repetition are literal, and named groups become positional (their names, which
    Java would restrict, are kept in ``Pattern.names``).  Look-around and back-references raise.
    """
    out: list[str] = []
    names: list[tuple[int, str]] = []
    groups, pos, multi = 0, 0, False
    scopes: list[bool] = []
    repeatable = False
    while pos < len(source):
        ch = source[pos]
        if ch == "\\":
            piece, pos = _escape(source, pos, False)
            out.append(piece)
            repeatable = True
        elif ch == "[":
            piece, pos = _bracket(source, pos)
            out.append(piece)
            repeatable = True
        elif ch == "(":
            named, flags = _NAMED.match(source, pos), _FLAGS.match(source, pos)
            repeatable = False
            if named:
                groups += 1
                if any(n == named.group(1) for _, n in names):
                    raise PatternError(f"duplicate group name {named.group(1)}")
                names.append((groups, named.group(1)))
                scopes.append(multi)
                out.append("(")
                pos = named.end()
            elif flags:
                on, off, end = flags.group(1), flags.group(2) or "", flags.group(3)
                if "U" in on + off:
                    raise PatternError("the ungreedy flag U is not supported")
                if end == ":":
                    scopes.append(multi)
                multi = (multi or "m" in on) and "m" not in off
                shown = on.replace("i", "iu") + ("-" + off.replace("i", "iu") if off else "")
                out.append(f"(?{shown}{end}")
                pos = flags.end()
            elif source.startswith("(?", pos):
                raise PatternError(f"unsupported group syntax at {source[pos:pos + 4]!r}")
            else:
                groups += 1
                scopes.append(multi)
                out.append("(")
                pos += 1
        elif ch == ")":
            if not scopes:
                raise PatternError("unexpected )")
            multi = scopes.pop()
            out.append(ch)
            pos += 1
            repeatable = True
        elif ch == "$":
            out.append("$" if multi else r"\z")
            pos += 1
            repeatable = True
        elif ch in "*+?" or (ch == "{" and _REPEAT.match(source, pos)):
            if not repeatable:
                raise PatternError(f"nothing to repeat before {ch!r}")
            end = _REPEAT.match(source, pos).end() if ch == "{" else pos + 1
            if source[end : end + 1] == "?":
                end += 1
            if source[end : end + 1] in ("*", "+") and source[end : end + 1]:
                raise PatternError("invalid nested repetition")
            out.append(source[pos:end])
            pos = end
            repeatable = False
        elif ch == "{":
            out.append(r"\{")
            pos += 1
            repeatable = True
        else:
            out.append(ch)
            pos += 1
            repeatable = ch not in "|"
    if scopes:
        raise PatternError("missing closing )")
    return Pattern("(?d)" + "".join(out), tuple(names), groups)


def replacement(template: str, pattern: Pattern) -> str:
    """Java replacement text for a ``$1`` / ``${name}`` template; unknown groups become empty."""
    out: list[str] = []
    pos, after_group = 0, False
    ref = re.compile(r"\$(?:\{(\w+)\}|(\w+))")
    while pos < len(template):
        ch = template[pos]
        match = ref.match(template, pos)
        if template.startswith("$$", pos):
            out.append(r"\$")
            pos, after_group = pos + 2, False
        elif match:
            name = match.group(1) or match.group(2)
            index = int(name) if name.isdigit() else pattern.index(name)
            if index is not None and index <= pattern.groups:
                out.append(f"${index}")
                after_group = True
            pos = match.end()
        else:
            if ch in "$\\" or (after_group and ch.isdigit()):
                out.append("\\")
            out.append(ch)
            pos, after_group = pos + 1, False
    return "".join(out)


def matches(value: Column, source: str) -> Column:
    return value.rlike(compile_pattern(source).java)


def replace_all(value: Column, source: str, template: str) -> Column:
    pattern = compile_pattern(source)
    return F.regexp_replace(value, pattern.java, replacement(template, pattern))


def replace_first(value: Column, source: str, literal: str) -> Column:
    """Replace the first match by literal text."""
    pattern = compile_pattern(source)
    body = pattern.java.removeprefix("(?d)")
    head = rf"(?d)\A((?s:.*?))(?:{body})"
    # The lazy head stops at the leftmost match; \A keeps it to one replacement.
    return F.regexp_replace(value, head, "$1" + literal.replace("\\", "\\\\").replace("$", "\\$"))


# Separators of the one-pass capture below; texts that hold them take the group-by-group path.
_MARK, _GAP = "\u0002", "\u0001"


def captures(value: Column, pattern: Pattern, wanted: list[int]) -> Column:
    """Array of the wanted groups of the leftmost match, NULL without a match.

    One regex pass rewrites the whole text to the captured groups, however many are wanted.
    """
    body = pattern.java.removeprefix("(?d)")
    whole = rf"(?d)\A(?s:.*?)(?:{body})(?s:.*)\z"
    packed = F.regexp_replace(value, whole, _MARK + _GAP.join(f"${i}" for i in wanted))
    quick = F.when(packed.startswith(_MARK), F.split(F.substring(packed, 2, 2147483647), _GAP))
    slow = F.when(
        value.rlike(pattern.java),
        F.array(*[F.regexp_extract(value, pattern.java, i) for i in wanted]),
    )
    special = value.contains(_MARK) | value.contains(_GAP)
    return F.when(value.isNull(), F.lit(None)).when(special, slow).otherwise(quick)
