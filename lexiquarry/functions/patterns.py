"""Java regular expressions of the text operators.

Scanning rules, not grammar: a string literal ends at its first quote that is not embedded. A quote after an odd run of
backslashes is embedded; after an even run it is embedded if a suspicious character follows, which is what damaged
escapes look like. An unterminated literal runs to the end. Groups are possessive, so long literals need no stack.
"""

#: A character that cannot follow a closing quote in sound code.
SUS = r"[A-Za-z0-9{}:,\[\]'_$\\]"
_BODY = rf'(?:[^"\\]++|\\(?:\\\\)*+"|(?:\\\\)++"(?={SUS})|\\++(?!"))*+'
CLOSED = rf'"{_BODY}(?:\\\\)*+"'
STRING = rf'"{_BODY}(?:(?:\\\\)*+"|\z)'
LINE_COMMENT = r"//[^\n]*+"
#: An unterminated one stops before the text's last character, which is scanned again.
BLOCK_COMMENT = r"/\*(?:(?:[^*]++|\*(?!/))*+\*/|.*(?=.\z)|\z)"
CHAR = r"'(?:\\[\x00-\x7f]|[\x00-\x7f&&[^\n'\\]])'"
LEXEMES = rf"""(?s)({LINE_COMMENT}|{BLOCK_COMMENT}|{STRING}|{CHAR}|[^/"']++|.)"""
UNICODE_ESCAPE = r"\\[uU]00(?:[2-6][0-9a-fA-F]|7[0-9a-eA-E])"
