"""Neutral names for methods, fields and local variables.

Works on the facts of the recogniser. Methods become func_1, func_2, ... in source order. Fields are numbered first,
var_1, var_2, ... over the whole file, a name that is declared again taking its last number everywhere; locals go on
from there, method by method. A name is resolved in the innermost scope that has it, and only inside method bodies. A
method within a method is gone over again on its own after the outer one, starting from the fields; of two edits at one
place the later wins.
"""

from __future__ import annotations

import re

from lexiquarry.operators import javaparse as jp

#: Whether the name in a catch clause is renamed like a local.
RENAME_CATCH = False

_IDENTIFIER = re.compile(r"[A-Za-z0-9_$]+")


def identifier_span(text: str) -> tuple[int, int] | None:
    """The first run of ASCII name characters."""
    m = _IDENTIFIER.search(text)
    return m.span() if m else None


class _Edits:
    """Edits by place; a later edit of the same place wins."""

    def __init__(self, parser: jp.Parser):
        self.tokens = parser.t
        self.by_span: dict[tuple[int, int], str] = {}

    def key(self, token: int) -> str | None:
        """The part of a token that counts as its name."""
        text = self.tokens[token].text
        span = identifier_span(text)
        return text[slice(*span)] if span else None

    def put(self, token: int, new: str) -> None:
        t = self.tokens[token]
        span = identifier_span(t.text)
        if span:
            self.by_span[t.start + span[0], t.start + span[1]] = new

    def apply(self, source: str) -> str:
        out, at = [], 0
        for (a, b), new in sorted(self.by_span.items()):
            out += [source[at:a], new]
            at = b
        return "".join([*out, source[at:]])


def _method_ends(facts: list[jp.Fact]) -> dict[int, int]:
    """Index of each METHOD fact with that of its LEAVE."""
    ends, open_ = {}, []
    for k, f in enumerate(facts):
        if f.kind == jp.METHOD:
            open_.append(k)
        elif f.kind == jp.LEAVE:
            ends[open_.pop()] = k
    return ends


def name_methods(parser: jp.Parser, edits: _Edits) -> None:
    """A2."""
    k = 0
    for f in parser.facts:
        if f.kind == jp.METHOD and edits.key(f.token) is not None:
            k += 1
            edits.put(f.token, f"func_{k}")


def name_variables(parser: jp.Parser, edits: _Edits) -> None:
    """Fields, then the locals of each method."""
    facts, ends, count = parser.facts, _method_ends(parser.facts), 0
    fields: dict[str, str] = {}
    for f in facts:
        if f.kind == jp.FIELD and (name := edits.key(f.token)) is not None:
            count += 1
            fields[name] = f"var_{count}"
    for f in facts:
        if f.kind == jp.FIELD and (name := edits.key(f.token)) is not None:
            edits.put(f.token, fields[name])

    for start, end in sorted(ends.items()):
        scopes = [dict(fields)]

        def declare(token: int, scopes: list[dict[str, str]] = scopes) -> None:
            nonlocal count
            if (name := edits.key(token)) is not None:
                count += 1
                scopes[-1][name] = f"var_{count}"
                edits.put(token, scopes[-1][name])

        inside = False
        for f in facts[start + 1 : end]:
            if not inside:
                if f.kind == jp.PARAM:
                    declare(f.token)
                inside = f.kind == jp.BODY
            elif f.kind == jp.PUSH:
                scopes.append({})
            elif f.kind == jp.POP:
                scopes.pop()
            elif f.kind == jp.DECLARE or (f.kind == jp.CATCH and RENAME_CATCH):
                declare(f.token)
            elif f.kind == jp.USE and (name := edits.key(f.token)) is not None:
                new = next((s[name] for s in reversed(scopes) if name in s), None)
                if new is not None:
                    edits.put(f.token, new)


def has_errors(source: str) -> bool:
    """whether the text is not well-formed."""
    return jp.parse(source)[1]


def rename(source: str) -> tuple[bool, str]:
    """Whether the text is broken, and the text with neutral names; of a broken text as much as could be read."""
    parser, broken = jp.parse(source)
    edits = _Edits(parser)
    name_methods(parser, edits)
    name_variables(parser, edits)
    return broken, edits.apply(source)


def identifier_facts(source: str) -> list[tuple[int, int, str, str, int, int, int, int]]:
    """(method, seq, name, role, pos, scope_start, scope_end, depth) of each declaration and use inside methods.

    Roles: method, field, declare, use. Scopes are given as ranges of seq, which numbers the facts of a file.
    """
    parser, _ = jp.parse(source)
    edits, facts = _Edits(parser), parser.facts
    ends = _method_ends(facts)
    out = []
    for k, f in enumerate(facts):
        if f.kind in (jp.METHOD, jp.FIELD) and (name := edits.key(f.token)) is not None:
            out.append((-1, k, name, f.kind, parser.t[f.token].start, 0, len(facts), 0))
    for start, end in sorted(ends.items()):
        closes, open_ = {start: end}, []
        for k in range(start + 1, end):
            if facts[k].kind == jp.PUSH:
                open_.append(k)
            elif facts[k].kind == jp.POP:
                closes[open_.pop()] = k
        open_, inside = [start], False
        for k in range(start + 1, end):
            f = facts[k]
            if not inside and f.kind != jp.PARAM:
                inside = f.kind == jp.BODY
                continue
            if f.kind == jp.PUSH:
                open_.append(k)
            elif f.kind == jp.POP:
                open_.pop()
            elif f.kind in (jp.DECLARE, jp.USE) or (f.kind == jp.PARAM and not inside):
                if (name := edits.key(f.token)) is not None:
                    role = "use" if f.kind == jp.USE else "declare"
                    out.append((start, k, name, role, parser.t[f.token].start, open_[-1], closes[open_[-1]], len(open_)))
    return out
