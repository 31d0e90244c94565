"""Java tokens with character offsets."""

from __future__ import annotations

import re
from typing import NamedTuple

#: Token kinds.
NAME, WORD, NUMBER, STRING, CHAR, OP, BAD, END = range(8)

#: Reserved words of the language.
RESERVED = frozenset(
    "abstract assert boolean break byte case catch char class const continue default do double else enum extends final "
    "finally float for goto if implements import instanceof int interface long native new package private protected "
    "public return short static strictfp super switch synchronized this throw throws transient try void volatile while "
    "true false null".split()
)
PRIMITIVES = frozenset("boolean byte char double float int long short".split())
MODIFIERS = frozenset("abstract final native private protected public static strictfp synchronized transient volatile default sealed".split())

#: Everything but '>' is taken as long as it goes; '>' comes alone, since it may close type arguments.
_TOKEN = re.compile(
    r"""
    (?P<skip> \s+ | //[^\n]* | /\*.*?\*/ )
  | (?P<string> \"{3}.*?(?<!\\)\"{3} | "(?:[^"\\\n]|\\.)*" )
  | (?P<char> '(?:[^'\\\n]|\\u+[0-9a-fA-F]{4}|\\[0-7]{1,3}|\\[^\n])' )
  | (?P<number> 0[xX][0-9a-fA-F_.]+(?:[pP][+-]?\d+)?[lLfFdD]? | 0[bB][01_]+[lL]? | (?:\d[\d_]*\.?[\d_]*|\.\d[\d_]*)(?:[eE][+-]?\d+)?[lLfFdD]? )
  | (?P<name> (?:[^\W\d]|\$)(?:\w|\$)* )
  | (?P<op> \.\.\. | <<= | -> | :: | \+\+ | -- | && | \|\| | [=!<]= | [-+*/%&|^]= | << | [-+*/%&|^!~?:=<>()\[\]{};,.@] )
  | (?P<bad> . )
    """,
    re.X | re.S,
)
_KINDS = {"string": STRING, "char": CHAR, "number": NUMBER, "name": NAME, "op": OP, "bad": BAD}


class Token(NamedTuple):
    kind: int
    text: str
    start: int
    end: int


def tokens(source: str) -> list[Token]:
    """All tokens but comments and white space; characters that begin none are BAD. END closes the list."""
    out = []
    for m in _TOKEN.finditer(source):
        group = m.lastgroup
        if group != "skip":
            text = m[0]
            kind = WORD if group == "name" and text in RESERVED else _KINDS[group]
            out.append(Token(kind, text, m.start(), m.end()))
    out.append(Token(END, "", len(source), len(source)))
    return out
