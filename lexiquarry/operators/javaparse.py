"""A Java recogniser that reports scope facts.

One recursive descent over the tokens decides whether a text is well-formed (syntax only: snippets of members or
statements are accepted) and lists, in source order, what renaming has to know: where methods, scopes and declarations
are and which names may be variables. No tree is built. Where the grammar needs unbounded look-ahead (casts, lambdas,
declarations) a guess is tried and its facts are taken back if it fails. An error skips to the end of the statement or
member, so that the facts around it survive.

Chains (else-if, the last part of a ternary, operators, suffixes) are loops and may be of any length. What is truly
nested is parsed by recursion, up to `_DEPTH` statements, expressions and operands within each other, some 5,000
parentheses; a text nested deeper counts as broken there. Texts that need more than Python's usual stack are parsed
again with a large one.
"""

from __future__ import annotations

import sys
import threading
from typing import NamedTuple

from lexiquarry.operators.javalex import BAD, CHAR, END, MODIFIERS, NAME, NUMBER, OP, PRIMITIVES, STRING, WORD, tokens

#: Kinds of facts. METHOD .. LEAVE enclose a method; BODY stands where its body begins.
METHOD, BODY, LEAVE, PARAM, FIELD, PUSH, POP, DECLARE, USE, CATCH = (
    "method", "body", "leave", "param", "field", "push", "pop", "declare", "use", "catch",
)

#: Choices where it depends on the grammar at hand which names count as variables.
LABELS_ARE_USES = True
REFERENCED_METHODS_ARE_USES = True

_ASSIGN = frozenset("= += -= *= /= %= &= |= ^= <<=".split())
_BINARY = frozenset("+ - * / % & | ^ && || == != < <= <<".split())
_DEPTH = 10_000
#: Stack of a deep parse, in Python frames and bytes; a level of depth takes some 12 frames at most.
_FRAMES, _STACK = 20 * _DEPTH, 512 << 20


class Fact(NamedTuple):
    kind: str
    token: int


class Broken(Exception):
    """The text is not well-formed here."""


class Parser:
    def __init__(self, source: str):
        self.t = tokens(source)
        self.at = 0
        self.facts: list[Fact] = []
        self.errors = sum(t.kind == BAD for t in self.t)
        self.inside_field = 0
        self.depth = 0
        self.body = "class"  # what kind of type the members belong to
        self.closing = self._closing("(", ")") | self._closing("{", "}")

    # --- tokens

    def _closing(self, opens: str, closes: str) -> dict[int, int]:
        """The place of each opening token with that of its closing one."""
        found, open_ = {}, []
        for k, x in enumerate(self.t):
            if x.kind == OP:
                if x.text == opens:
                    open_.append(k)
                elif x.text == closes and open_:
                    found[open_.pop()] = k
        return found

    def text(self, ahead: int = 0) -> str:
        t = self.t[min(self.at + ahead, len(self.t) - 1)]
        return t.text if t.kind in (OP, WORD, NAME) else ""

    def kind(self, ahead: int = 0) -> int:
        return self.t[min(self.at + ahead, len(self.t) - 1)].kind

    def take(self, *texts: str) -> bool:
        if self.text() in texts and self.text():
            self.at += 1
            return True
        return False

    def need(self, *texts: str) -> None:
        if not self.take(*texts):
            raise Broken(self.at)

    def name(self) -> int:
        if self.kind() != NAME:
            raise Broken(self.at)
        self.at += 1
        return self.at - 1

    def say(self, kind: str, token: int = -1) -> None:
        self.facts.append(Fact(kind, token if token >= 0 else self.at))

    def guess(self, parse) -> bool:
        """Try parse; without success nothing has happened."""
        at, facts, inside, depth, body = self.at, len(self.facts), self.inside_field, self.depth, self.body
        errors = self.errors
        try:
            if parse() is not False:
                return True
        except Broken:
            pass
        self.errors = errors
        self.at, self.inside_field, self.depth, self.body = at, inside, depth, body
        del self.facts[facts:]
        return False

    def recover(self, start: int, facts: int) -> None:
        """Skip the broken statement that begins at start: to its ';' or its closing brace."""
        self.errors += 1
        del self.facts[facts:]
        self.at = start
        while self.kind() != END:
            x = self.text()
            if x == "}":
                return
            if x == "{":  # with all that is in it, or else to the end
                self.at = self.closing.get(self.at, len(self.t) - 2) + 1
                return
            self.at += 1
            if x == ";":
                return

    def many(self, parse, until: str) -> None:
        """Statements or members up to `until` or the end, each with its own recovery."""
        while self.kind() != END and self.text() != until:
            start, facts, inside, depth, body = self.at, len(self.facts), self.inside_field, self.depth, self.body
            try:
                parse()
            except Broken:
                self.inside_field, self.depth, self.body = inside, depth, body
                self.recover(start, facts)
                if self.at == start:
                    self.at += 1

    # --- program, types of declarations

    def program(self) -> None:
        self.many(self.top, "")

    def top(self) -> None:
        if self.text() == "}":
            raise Broken(self.at)
        if not (self.guess(self.package_or_import) or self.guess(self._local_type) or self.guess(self.method)):
            self.statement()

    def package_or_import(self) -> bool | None:
        self.modifiers()
        if self.take("import"):
            self.take("static")
        elif not self.take("package"):
            return False
        self.name()
        while self.take("."):
            if self.take("*"):
                break
            self.name()
        self.need(";")
        return None

    def modifiers(self) -> None:
        while True:
            if self.text() == "@" and self.text(1) != "interface":
                self.annotation()
            elif self.text() in MODIFIERS and not (self.text() == "default" and self.text(1) in (":", "->")):
                if self.text() == "sealed" and self.kind(1) not in (WORD, NAME):
                    return
                self.at += 1
            elif self.text() == "non" and self.text(1) == "-" and self.text(2) == "sealed":
                self.at += 3
            else:
                return

    def annotation(self) -> None:
        self.need("@")
        first = self.name()
        if self.text() != ".":
            self.say(USE, first)
        while self.take("."):
            self.name()
        if self.take("("):
            while not self.take(")"):
                if self.kind() == NAME and self.text(1) == "=":
                    self.at += 2
                self.element()
                if not self.take(","):
                    self.need(")")
                    break

    def element(self) -> None:
        if self.text() == "@":
            self.annotation()
        elif self.take("{"):
            while not self.take("}"):
                self.element()
                if not self.take(","):
                    self.need("}")
                    break
        else:
            self.expression()

    def declares_type(self) -> bool:
        """Whether a type declaration begins here, after modifiers."""
        x = self.text()
        if x in ("class", "interface", "enum") or (x == "@" and self.text(1) == "interface"):
            return True
        return x == "record" and self.kind(1) == NAME and self.text(2) in ("(", "<")

    def type_declaration(self) -> None:
        what = "annotation" if self.take("@") else self.text()
        self.at += 1
        self.name()
        self.type_parameters()
        if what == "record":
            self.parameters(False)
        while self.take("extends", "implements", "permits"):
            self.type()
            while self.take(","):
                self.type()
        self.class_body(what)

    def class_body(self, what: str = "class") -> None:
        self.need("{")
        if what == "enum":
            self.constants()
        outer, self.body = self.body, what
        self.many(self.member if what != "record" else self.record_member, "}")
        self.body = outer
        self.need("}")

    def constants(self) -> None:
        while self.kind() == NAME or self.text() == "@":
            self.modifiers()
            self.name()
            if self.text() == "(":
                self.arguments()
            if self.text() == "{":
                self.class_body()
            if not self.take(","):
                break
        if self.text() != "}":
            self.need(";")

    def record_member(self) -> None:
        def compact() -> bool | None:
            self.modifiers()
            self.name()
            if self.text() != "{":
                return False
            self.block()
            return None

        if not self.guess(compact):
            self.member()

    def member(self) -> None:
        if self.take(";"):
            return
        if self.text() == "{" or (self.text() == "static" and self.text(1) == "{"):
            self.take("static")
            self.block()
            return
        start, facts = self.at, len(self.facts)
        self.modifiers()
        if self.declares_type():
            self.type_declaration()
            return
        if self.kind() == NAME and self.text(1) == "(" or self.text() == "<" and self.guess(self._generic_constructor):
            self.constructor()
            return
        self.at = start
        del self.facts[facts:]
        if self.guess(self.method):
            return
        self.modifiers()
        self.type()
        self.inside_field += 1
        while True:
            token = self.name()
            if self.inside_field == 1 and self.body not in ("interface", "annotation"):  # those hold constants
                self.say(FIELD, token)
            self.dimensions()
            if self.take("="):
                self.initializer()
            if not self.take(","):
                break
        self.need(";")
        self.inside_field -= 1

    def _generic_constructor(self) -> bool:
        self.type_parameters()
        return self.kind() == NAME and self.text(1) == "("

    def constructor(self) -> None:
        self.type_parameters()
        self.name()
        self.parameters(False)
        self.throws()
        self.block()

    def throws(self) -> None:
        if self.take("throws"):
            self.type()
            while self.take(","):
                self.type()

    def method(self) -> bool | None:
        self.modifiers()
        self.type_parameters()
        self.annotations()
        if not self.take("void"):
            self.type()
        if self.kind() != NAME or self.text(1) != "(":
            return False
        if self.body == "annotation":  # an element, no method
            self.name()
            self.parameters(False)
            self.dimensions()
            if self.take("default"):
                self.element()
            self.need(";")
            return None
        self.say(METHOD, self.name())
        self.parameters(True)
        self.dimensions()
        self.throws()
        if self.take("default"):
            self.element()
        if not self.take(";"):
            self.say(BODY)
            if self.text() != "{":
                return False
            self.block()
        self.say(LEAVE)
        return None

    def annotations(self) -> None:
        while self.text() == "@" and self.text(1) != "interface":
            self.annotation()

    def parameters(self, of_method: bool, kind: str = PARAM) -> None:
        self.need("(")
        while not self.take(")"):
            self.modifiers()
            self.type()
            self.annotations()
            spread = self.take("...")
            if self.take("this") or (self.kind() == NAME and self.text(1) == "." and self.text(2) == "this"):  # a receiver
                while self.text() not in (",", ")") and self.kind() != END:
                    self.at += 1
            else:
                token = self.name()
                self.dimensions()
                if of_method and not spread:
                    self.say(kind, token)
            if not self.take(","):
                self.need(")")
                break

    def type_parameters(self) -> None:
        if self.take("<"):
            while True:
                self.annotations()
                self.name()
                if self.take("extends"):
                    self.type()
                    while self.take("&"):
                        self.type()
                if not self.take(","):
                    break
            self.need(">")

    # --- types

    def type(self) -> None:
        self.annotations()
        if self.text() in PRIMITIVES:
            self.at += 1
        else:
            self.name()
            self.type_arguments()
            while self.text() == "." and (self.kind(1) == NAME or self.text(1) == "@"):
                self.at += 1
                self.annotations()
                self.name()
                self.type_arguments()
        self.dimensions()

    def dimensions(self) -> None:
        while True:
            if self.text() == "@" and not self.guess(lambda: (self.annotations(), self.text() == "[")[1]):
                return
            if self.text() != "[" or self.text(1) != "]":
                return
            self.at += 2

    def type_arguments(self) -> None:
        if self.text() != "<":
            return
        self.at += 1
        if self.take(">"):
            return
        while True:
            self.annotations()
            if self.take("?"):
                if self.take("extends", "super"):
                    self.type()
            else:
                self.type()
            if not self.take(","):
                break
        self.need(">")

    # --- statements

    def block(self) -> None:
        self.need("{")
        self.say(PUSH)
        self.many(self.statement, "}")
        self.need("}")
        self.say(POP)

    def parens(self) -> None:
        self.need("(")
        self.expression()
        self.need(")")

    def statement(self) -> None:
        self.depth += 1
        if self.depth > _DEPTH:
            raise Broken(self.at)
        x = self.text()
        handler = self.STATEMENTS.get(x)
        if x == "{":
            self.block()
        elif x == ";":
            self.at += 1
        elif handler and not (x == "synchronized" and self.text(1) != "("):
            self.at += 1
            handler(self)
        elif x == "yield" and self.kind() == NAME and self.text(1) not in ("=", ".", "(", "[", "++", "--", ":", "::") and self.text(1) not in _ASSIGN:
            self.at += 1
            self.expression()
            self.need(";")
        elif self.kind() == NAME and self.text(1) == ":":
            if LABELS_ARE_USES:
                self.say(USE)
            self.at += 2
            self.statement()
        elif self.guess(self._local_type):
            pass
        elif self.guess(lambda: (self.local_variables(), self.need(";"))[0]):
            pass
        else:
            self.expression()
            self.need(";")
        self.depth -= 1

    def _local_type(self) -> bool | None:
        self.modifiers()
        if not self.declares_type():
            return False
        self.type_declaration()
        return None

    def local_variables(self, first_only: bool = False) -> None:
        """A declaration up to its ';'. All names are declared before any value is looked at."""
        self.modifiers()
        self.type()
        at, names = len(self.facts), []
        while True:
            names.append(self.name())
            self.dimensions()
            if self.text() not in ("=", ",", ";"):
                raise Broken(self.at)
            if self.take("="):
                self.initializer()
            if not self.take(","):
                break
        self.facts[at:at] = [Fact(DECLARE, n) for n in names]

    def initializer(self) -> None:
        if self.take("{"):
            while not self.take("}"):
                self.initializer()
                if not self.take(","):
                    self.need("}")
                    break
        else:
            self.expression()

    def _if(self) -> None:
        self.parens()
        self.statement()
        while self.take("else"):
            if not self.take("if"):
                self.statement()
                break
            self.parens()
            self.statement()

    def _while(self) -> None:
        self.parens()
        self.statement()

    def _do(self) -> None:
        self.statement()
        self.need("while")
        self.parens()
        self.need(";")

    def _for(self) -> None:
        self.need("(")
        self.say(PUSH)

        def each() -> None:
            self.modifiers()
            self.type()
            token = self.name()
            self.dimensions()
            self.need(":")
            self.say(DECLARE, token)
            self.expression()
            self.need(")")

        if not self.guess(each):
            if not self.take(";"):
                if not self.guess(lambda: (self.local_variables(), self.need(";"))[0]):
                    self.expressions()
                    self.need(";")
            if self.text() != ";":
                self.expression()
            self.need(";")
            if self.text() != ")":
                self.expressions()
            self.need(")")
        self.statement()
        self.say(POP)

    def expressions(self) -> None:
        self.expression()
        while self.take(","):
            self.expression()

    def _value(self) -> None:
        if self.text() != ";":
            self.expression()
        self.need(";")

    def _throw(self) -> None:
        self.expression()
        self.need(";")

    def _jump(self) -> None:
        if self.kind() == NAME:
            if LABELS_ARE_USES:
                self.say(USE)
            self.at += 1
        self.need(";")

    def _assert(self) -> None:
        self.expression()
        if self.take(":"):
            self.expression()
        self.need(";")

    def _synchronized(self) -> None:
        self.parens()
        self.block()

    def _try(self) -> None:
        resources = self.take("(")
        if resources:
            while not self.take(")"):
                self.resource()
                if not self.take(";"):
                    self.need(")")
                    break
        self.block()
        handlers = 0
        while self.take("catch"):
            handlers += 1
            self.need("(")
            self.modifiers()
            self.type()
            while self.take("|"):
                self.type()
            self.say(CATCH, self.name())
            self.dimensions()
            self.need(")")
            self.block()
        if self.take("finally"):
            handlers += 1
            self.block()
        if not handlers and not resources:
            raise Broken(self.at)

    def resource(self) -> None:
        def declared() -> None:
            self.modifiers()
            self.type()
            token = self.name()
            self.dimensions()
            self.need("=")
            self.say(DECLARE, token)
            self.expression()

        if not self.guess(declared):
            self.expression()

    def _switch(self) -> None:
        self.parens()
        self.need("{")
        while not self.take("}"):
            if self.take("default"):
                pass
            else:
                self.need("case")
                while True:
                    if not self.take("default") and not self.guess(self.pattern):
                        self.ternary_free()
                    if not self.take(","):
                        break
                if self.text() == "when" and self.kind() == NAME:
                    self.at += 1
                    self.expression()
            if self.take("->"):
                if self.text() == "{":
                    self.block()
                elif self.take("throw"):
                    self._throw()
                else:
                    self.expression()
                    self.need(";")
            else:
                self.need(":")
                while self.text() not in ("case", "default", "}"):
                    if self.kind() == END:
                        raise Broken(self.at)
                    self.statement()

    def pattern(self) -> bool | None:
        self.modifiers()
        self.type()
        if self.take("("):
            while not self.take(")"):
                if not self.guess(self.pattern):
                    return False
                if not self.take(","):
                    self.need(")")
                    break
            if self.kind() == NAME and self.text() != "when":
                self.at += 1
            return None
        self.say(USE, self.name())
        return None

    STATEMENTS = {
        "if": _if, "while": _while, "do": _do, "for": _for, "return": _value, "throw": _throw, "break": _jump,
        "continue": _jump, "assert": _assert, "synchronized": _synchronized, "try": _try, "switch": _switch,
    }

    # --- expressions: operands and operators in turn; precedence changes neither facts nor acceptance

    def expression(self) -> None:
        self.depth += 1
        if self.depth > _DEPTH:
            raise Broken(self.at)
        self.operand()
        while True:
            if self.take("?"):
                self.expression()
                self.need(":")
                self.operand()
            elif not self.operator():
                break
        self.depth -= 1

    def ternary_free(self) -> None:
        """An expression that may stand before '->' or ':'."""
        self.operand(no_lambda=True)
        while self.operator():
            pass

    def operator(self) -> bool:
        """An operator with what follows it; False if none is here."""
        x = self.text()
        if x in _ASSIGN or x in _BINARY:
            self.at += 1
            self.operand()
        elif x == ">":
            end = self.t[self.at].end
            self.at += 1
            while self.text() in (">", "==", "=") and self.t[self.at].start == end:  # >> >>> >= >>=
                end = self.t[self.at].end
                self.at += 1
                if self.t[self.at - 1].text != ">":
                    break
            self.operand()
        elif x == "instanceof":
            self.at += 1
            if not self.guess(self.pattern):
                self.modifiers()
                self.type()
        else:
            return False
        return True

    def operand(self, no_lambda: bool = False) -> None:
        self.depth += 1
        if self.depth > _DEPTH:
            raise Broken(self.at)
        while self.take("+", "-", "!", "~", "++", "--"):
            pass
        if not no_lambda and self.is_lambda():
            self.lambda_()
        elif self.text() == "(" and self.guess(self.cast):
            pass
        else:
            self.primary()
            self.suffixes()
        self.depth -= 1

    def is_lambda(self) -> bool:
        if self.kind() == NAME:
            return self.text(1) == "->"
        if self.text() != "(":
            return False
        k = self.closing.get(self.at)
        return k is not None and self.t[k + 1].text == "->"

    def lambda_(self) -> None:
        self.say(PUSH)
        if self.kind() == NAME:
            self.say(USE)  # a bare parameter is no declaration
            self.at += 1
        elif not self.guess(self._inferred):
            self.parameters(True, DECLARE)
        self.need("->")
        if self.text() == "{":
            self.block()
        else:
            self.expression()
        self.say(POP)

    def _inferred(self) -> None:
        self.need("(")
        while not self.take(")"):
            self.say(DECLARE, self.name())
            if not self.take(","):
                self.need(")")
                break

    def cast(self) -> bool | None:
        self.need("(")
        primitive = self.text() in PRIMITIVES
        self.type()
        while self.take("&"):
            self.type()
            primitive = False
        if self.text() == ")" and self.t[self.at - 1].text == "]":
            primitive = False
        self.need(")")
        starts = self.kind() in (NAME, STRING, CHAR, NUMBER) or self.text() in ("(", "!", "~", "this", "super", "new", "switch", "true", "false", "null", *PRIMITIVES)
        if not starts and not (primitive and self.text() in ("+", "-", "++", "--")):
            return False
        self.operand()
        return None

    def arguments(self) -> None:
        self.need("(")
        if self.take(")"):
            return
        self.expressions()
        self.need(")")

    def primary(self) -> None:
        x, kind = self.text(), self.kind()
        if kind in (NUMBER, STRING, CHAR):
            self.at += 1
        elif kind == NAME:
            if self.text(1) in ("<", "[", ".", "@") and self.guess(self._typed_reference):
                return
            self.at += 1
            if self.text() == "(":
                self.arguments()
            else:
                self.say(USE, self.at - 1)
        elif x in ("true", "false", "null"):
            self.at += 1
        elif x in ("this", "super"):
            self.at += 1
            if self.text() == "(":
                self.arguments()
        elif x == "(":
            self.parens()
        elif x == "new":
            self.creation()
        elif x == "switch":
            self.at += 1
            self._switch()
        elif x in PRIMITIVES or x == "void":
            self.at += 1
            self.dimensions()
            if self.text() == "." and self.text(1) == "class":
                self.at += 2
            elif self.text() != "::":
                raise Broken(self.at)
        else:
            raise Broken(self.at)

    def _typed_reference(self) -> bool:
        """A type that can only be one: with type arguments or dimensions, before '::' or '.class'."""
        first = self.at
        self.type()
        plain = all(t.text not in ("<", "]") for t in self.t[first : self.at])
        return not plain and (self.text() == "::" or (self.text() == "." and self.text(1) == "class"))

    def suffixes(self) -> None:
        while True:
            x = self.text()
            if x == ".":
                self.at += 1
                self.type_arguments()
                if self.text() == "new":
                    self.creation()
                elif self.take("class"):
                    pass
                elif self.take("this", "super"):
                    if self.text() == "(":
                        self.arguments()
                else:
                    self.name()
                    if self.text() == "(":
                        self.arguments()
            elif x == "[":
                self.at += 1
                self.expression()
                self.need("]")
            elif x == "::":
                self.at += 1
                self.type_arguments()
                if not self.take("new"):
                    token = self.name()
                    if REFERENCED_METHODS_ARE_USES:
                        self.say(USE, token)
            elif x in ("++", "--"):
                self.at += 1
            else:
                return

    def creation(self) -> None:
        self.need("new")
        self.type_arguments()
        self.annotations()
        if self.text() in PRIMITIVES:
            self.at += 1
        else:
            self.name()
            self.type_arguments()
            while self.take("."):
                self.annotations()
                self.name()
                self.type_arguments()
        self.annotations()
        if self.text() == "[":
            if self.text(1) == "]":
                self.dimensions()
                if self.text() != "{":
                    raise Broken(self.at)
                self.initializer()
                return
            while self.text() == "[" and self.text(1) != "]":
                self.at += 1
                self.expression()
                self.need("]")
                self.annotations()
            self.dimensions()
            return
        self.arguments()
        if self.text() == "{":
            self.class_body()


def parse(source: str) -> tuple[Parser, bool]:
    """The parser with its tokens and facts, and whether the text is broken anywhere."""
    p = Parser(source)
    try:
        p.program()
    except RecursionError:
        p = _parse_deep(source)
    return p, p.errors > 0


def _parse_deep(source: str) -> Parser:
    """The same with a stack of _FRAMES."""
    p = Parser(source)
    failed: list[BaseException] = []

    def run() -> None:
        try:
            p.program()
        except RecursionError:
            p.errors += 1
        except BaseException as e:
            failed.append(e)

    frames, size = sys.getrecursionlimit(), threading.stack_size(_STACK)
    try:
        sys.setrecursionlimit(max(frames, _FRAMES))
        thread = threading.Thread(target=run)
        thread.start()
        thread.join()
    finally:
        threading.stack_size(size)
        sys.setrecursionlimit(frames)
    if failed:
        raise failed[0]
    return p
