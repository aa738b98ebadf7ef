"""Assignments in source and configuration text: which literals a name gets, directly or through other names.

The lexer looks for places that bind a name: ``name = value`` and its kin (``:``, ``:=``, ``=>``, a type
before the sign, quoted and subscripted names), tuples of names, ``call("name", value)``, ``--name value``,
XML elements and ``name``/``value`` attributes. A value is one literal, several joined by ``+``
and its kin, a list of either, or a block of indented lines; strings may have prefixes, triple quotes and
parentheses around them. Names in values refer to the binding before them, else to the first one after.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable
from typing import NamedTuple

#: A value is told by so many characters; what further constants would add changes no score.
CLOSED = 256

_NAME = r"[A-Za-z_$][A-Za-z0-9_.\-]*"
# A name only starts where the run of name characters starts, so long runs are read once.
_PAIR = re.compile(
    r"""(?<![A-Za-z0-9_.\-$])(["'`]?)(?P<name>[A-Za-z_$][A-Za-z0-9_.\-]*)\1\]?[ \t]*"""
    r"""(?::[ \t]*[A-Za-z_][A-Za-z0-9_.]*[ \t]*=|:=|=>|=|:)(?!=)[ \t]*""", re.A)
_TUPLE = re.compile(rf"(?m)^[ \t]*(?:(?:local|let|var|const|my)[ \t]+)?\(?(?P<names>{_NAME}(?:[ \t]*,[ \t]*{_NAME})+)\)?[ \t]*:?=(?!=)[ \t]*", re.A)
_CALL = re.compile(rf"""\([ \t]*(["'])(?P<name>{_NAME})\1[ \t]*,[ \t]*""", re.A)
_OPTION = re.compile(r"(?<![\w\-])--?(?P<name>[A-Za-z][A-Za-z0-9_\-]*)(?:[ \t]+|=)(?=[\"'A-Za-z0-9$/+])", re.A)
_ELEMENT = re.compile(rf"<(?P<name>{_NAME})(?:\s[^<>]*)?>(?:<!\[CDATA\[)?(?P<value>[^<>]*?)(?:\]\]>)?</(?P=name)", re.A)
_ATTRIBUTE = re.compile(rf"""\b(?:name|key|id)=(["'])(?P<name>{_NAME})\1\s+value=(?=["'])""", re.A)

_STRING = re.compile(
    r'''[rRbBfFuUlL@$]{0,2}(?:"""(.*?)"""|\'\'\'(.*?)\'\'\'|"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)''', re.S)
_BARE = re.compile(r"[A-Za-z0-9_$][A-Za-z0-9+/_.=$@-]*", re.A)
_BLOCK = re.compile(r"[|>][+\-]?[0-9]?[ \t]*\n")
_LINE = re.compile(r"([ \t]*)([^\n]*)(\n|\Z)")
_NEXT_LINE = re.compile(r"\\?\n\s*(?=[rRbBfFuU]?[\"'])")
_ARGUMENTS = re.compile(r"\([^()\n]{0,200}\)")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|\|\||\?\?|\bor\b|\.(?=[ \t]*[\"'$]))[ \t]*(?:\\?\n[ \t]*)?")
_BESIDE = re.compile(r"\s*(?=[rRbBfFuU]?[\"'])")
_COMMA = re.compile(r"\s*,\s*")
_LINE_COMMA = re.compile(r"[ \t]*,[ \t]*")
_SPACE = re.compile(r"\s*")


class Literal(NamedTuple):
    start: int
    end: int
    quoted: bool


class Binding(NamedTuple):
    """A name and what its value is joined from, in order; bare words may be names."""

    name: str
    terms: list[Literal]


def _joined(text: str, at: int, enclosed: bool) -> tuple[list[Literal], int]:
    """The literals joined at a place, and where they end."""
    terms: list[Literal] = []
    while True:
        string = _STRING.match(text, at)
        if string:
            terms.append(Literal(*string.span(string.lastindex), True))
            at = string.end()
        elif bare := _BARE.match(text, at):
            at = bare.end()
            if text.startswith("(", at):  # a call: what it gives is not a literal
                call = _ARGUMENTS.match(text, at)
                if not call:
                    return terms, at
                at = call.end()
            else:
                terms.append(Literal(*bare.span(), False))
        else:
            return terms, at
        more = _JOIN.match(text, at) or (enclosed and _BESIDE.match(text, at))
        if not more:
            return terms, at
        at = more.end()


def _values(text: str, at: int) -> tuple[list[list[Literal]], int]:
    """The elements of the value at a place, each joined from literals; one unless brackets hold a list."""
    if block := _BLOCK.match(text, at):
        return _block(text, at, block.end())
    if broken := _NEXT_LINE.match(text, at):
        at = broken.end()
    depth = 0
    while text[at : at + 1] in ("(", "["):
        depth, at = depth + 1, _SPACE.match(text, at + 1).end()
    out = []
    while True:
        terms, at = _joined(text, at, depth > 0)
        if terms:
            out.append(terms)
        comma = depth and _COMMA.match(text, at)
        if not comma or comma.end() == len(text):
            return out, at
        if not terms and comma.end() == at:
            return out, at
        at = comma.end()


def _block(text: str, key: int, at: int) -> tuple[list[list[Literal]], int]:
    """The lines below a key that are indented further than its line."""
    line = _LINE.match(text, text.rfind("\n", 0, key) + 1)
    indent, terms = len(line[1]), []
    while at < len(text):
        line = _LINE.match(text, at)
        content = line[2].rstrip()
        if content and len(line[1]) <= indent:
            break
        if content:
            terms.append(Literal(line.start(2), line.start(2) + len(content), True))
        at = line.end()
    return [terms] if terms else [], at


def bindings(text: str, sensitive: Callable[[str], object]) -> list[Binding]:
    """All bindings of a text in order. Forms that only ever hold settings are read where the name is ``sensitive``."""
    kinds = [_PAIR, _TUPLE, _CALL, _OPTION, *((_ELEMENT, _ATTRIBUTE) if "<" in text else ())]
    found = [kind.search(text) for kind in kinds]
    at, out = 0, []
    while any(found):
        number = min((i for i, m in enumerate(found) if m), key=lambda i: (found[i].start(), -i))
        kind, match = kinds[number], found[number]
        after = match.end()
        if match.start() >= at:
            if kind is _TUPLE:
                names = [n.strip() for n in match["names"].split(",")]
                values, end = _listed(text, after)
                if len(values) == len(names):
                    out += [Binding(n, v) for n, v in zip(names, values) if v]
                    at = end
            elif kind is _ELEMENT:
                value = match["value"].strip()
                if value and sensitive(match["name"]):
                    start = match.start("value") + match["value"].index(value)
                    out.append(Binding(match["name"], [Literal(start, start + len(value), True)]))
                    at = after
            elif kind is _PAIR or sensitive(match["name"]):
                values, end = _values(text, after)
                out += [Binding(match["name"], v) for v in values]
                read = [x for v in values for x in v]
                # A lone bare word may bind what follows it; all else is read once.
                if len(read) > 1 or any(x.quoted or "=" in text[x.start : x.end] for x in read):
                    at = max(at, end)
                elif kind is _OPTION:
                    at = after
        found[number] = kind.search(text, max(at, after) if kind is _PAIR or kind is _TUPLE else max(at, match.start() + 1))
    return out


def _listed(text: str, at: int) -> tuple[list[list[Literal]], int]:
    """Values between commas on one line, with or without brackets around all."""
    if text[at : at + 1] in ("(", "["):
        return _values(text, at)
    out = []
    while True:
        terms, at = _joined(text, at, False)
        out.append(terms)
        comma = _LINE_COMMA.match(text, at)
        if not comma:
            return out, at
        at = comma.end()


class Resolved(NamedTuple):
    """A binding's value, cut at ``CLOSED`` characters, whether a part of it was quoted, its own literals, and the bindings it refers to."""

    name: str
    value: str
    quoted: bool
    literals: list[Literal]
    others: list[int]


def resolved(text: str, found: list[Binding]) -> list[Resolved]:
    """The bindings with constants carried along; each is read once, however often and in whatever order names refer to each other."""
    places: dict[str, list[int]] = {}
    for i, binding in enumerate(found):
        places.setdefault(binding.name, []).append(i)

    def refers(i: int, term: Literal) -> int | None:
        """The binding that a bare word names: the last before this one, else the first after; -1 for the binding itself alone."""
        known = None if term.quoted else places.get(text[term.start : term.end])
        if not known:
            return None
        at = bisect_left(known, i)
        if at:
            return known[at - 1]
        return next((j for j in known[at : at + 2] if j != i), -1)

    parts = [[(term, refers(i, term)) for term in binding.terms] for i, binding in enumerate(found)]
    values: list[tuple[str, bool] | None] = [None] * len(found)
    for first in range(len(found)):
        waiting, open_ = [first], set()
        while waiting:
            i = waiting[-1]
            if values[i] is None and i not in open_:
                open_.add(i)  # a name that refers to itself through others adds nothing
                waiting += [j for _, j in parts[i] if j is not None and j >= 0 and values[j] is None and j not in open_]
                continue
            waiting.pop()
            if values[i] is not None:
                continue
            value, quoted = "", False
            for term, j in parts[i]:
                if j is None:
                    value, quoted = (value + text[term.start : min(term.end, term.start + CLOSED)])[:CLOSED], quoted or term.quoted
                elif j >= 0 and values[j]:
                    value, quoted = (value + values[j][0])[:CLOSED], quoted or values[j][1]
            values[i] = value, quoted
    return [
        Resolved(b.name, *values[i], [t for t, j in parts[i] if j is None], [j for _, j in parts[i] if j is not None and j >= 0])
        for i, b in enumerate(found)
    ]


def reaching(rows: list[Resolved], scores: dict[int, float]) -> dict[tuple[int, int], float]:
    """The literals that scored bindings consist of, each with the highest of their scores."""
    out: dict[tuple[int, int], float] = {}
    seen: set[int] = set()
    for i in sorted(scores, key=lambda i: -scores[i]):
        waiting = [i]
        while waiting:
            j = waiting.pop()
            if j in seen:
                continue
            seen.add(j)
            waiting += rows[j].others
            for x in rows[j].literals:
                if x.end > x.start:
                    out.setdefault((x.start, x.end), scores[i])
    return out
