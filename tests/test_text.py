"""Text operators against plain models that scan character by character."""

import random

import pytest
from pyspark.sql import functions as F

from lexiquarry.functions import literals, repair
from lexiquarry.functions.tokens import count_tokens

SUSPICIOUS = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789{}:,[]'_$\\")


def literal_end(s: str, i: int) -> tuple[int, bool]:
    """End of the string literal that begins at i, and whether it is closed."""
    j = i + 1
    while j < len(s):
        if s[j] == '"':
            return j + 1, True
        if s[j] != "\\":
            j += 1
            continue
        k = j
        while k < len(s) and s[k] == "\\":
            k += 1
        if k < len(s) and s[k] == '"':
            embedded = (k - j) % 2 or (k + 1 < len(s) and s[k + 1] in SUSPICIOUS)
            if not embedded:
                return k + 1, True
            k += 1
        j = k
    return len(s), False


def char_end(s: str, i: int) -> int | None:
    if i + 3 < len(s) and s[i + 1] == "\\" and ord(s[i + 2]) < 128 and s[i + 3] == "'":
        return i + 4
    if i + 2 < len(s) and s[i + 1] not in "\n'\\" and ord(s[i + 1]) < 128 and s[i + 2] == "'":
        return i + 3
    return None


def model_lexemes(s: str):
    i = 0
    while i < len(s):
        if s.startswith("//", i):
            j = s.find("\n", i)
            j = len(s) if j < 0 else j
            yield "comment", s[i:j]
        elif s.startswith("/*", i):
            j = s.find("*/", i + 2)
            j = j + 2 if j >= 0 else max(len(s) - 1, i + 2)
            yield "comment", s[i:j]
        elif s[i] == '"':
            j, _ = literal_end(s, i)
            yield "string", s[i:j]
        elif s[i] == "'" and char_end(s, i):
            j = char_end(s, i)
            yield "char", s[i:j]
        else:
            j = i + 1
            yield "other", s[i:j]
        i = j


def model_blank(s: str) -> str:
    return "".join({"string": '"_"', "char": "'X'"}.get(kind, x) for kind, x in model_lexemes(s))


def model_mask(s: str) -> tuple[str, list[tuple[str, str]]]:
    out, store = "", []
    for kind, x in model_lexemes(s):
        mark = {"string": f'"STR_{len(store)}"', "char": "'X'"}.get(kind)
        if mark:
            store.append((mark, x))
        out += mark or x
    return out, store


def model_restore(s: str, store) -> str:
    out, at = "", 0
    for mark, original in store:
        k = s.find(mark, at)
        if k >= 0:
            out += s[at:k] + original
            at = k + len(mark)
    return out + s[at:]


def model_unicode(s: str) -> str:
    out, i = "", 0
    while i < len(s):
        x = s[i : i + 6]
        if len(x) == 6 and x[0] == "\\" and x[1] in "uU" and all(c in "0123456789abcdefABCDEF" for c in x[2:]) and 0x20 <= int(x[2:], 16) <= 0x7E:
            out, i = out + chr(int(x[2:], 16)), i + 6
        else:
            out, i = out + s[i], i + 1
    return out


def model_apostrophes(s: str) -> str:
    out, i = "", 0
    while i < len(s):
        k = i
        while k < len(s) and s[k] == "\\":
            k += 1
        n = k - i
        if n and k < len(s) and s[k] == "'" and n % 2:
            n -= 1
        out += "\\" * n + s[k : k + 1]
        i = k + 1
    return out


def model_line_breaks(s: str) -> str:
    out, i = "", 0
    while i < len(s):
        if s[i] == '"':
            j, _ = literal_end(s, i)
            out += s[i:j].replace("\n", "\\n").replace("\r", "\\r")
            i = j
        else:
            out, i = out + s[i], i + 1
    return out


def model_nul(s: str) -> str:
    out, i = "", 0
    while i < len(s):
        if s[i] == "\0":
            i += 1
        elif s.startswith("\r\n", i):
            out, i = out + "\n", i + 2
        else:
            out, i = out + s[i], i + 1
    return out


def model_backslashes(s: str) -> str:
    while True:
        t = s.replace('\\\\\\"', '\\"').replace('\\\\"', '\\"')
        if len(t) == len(s):
            return t
        s = t


def model_closed(s: str) -> list[str]:
    out, i = [], 0
    while i < len(s):
        if s[i] == '"':
            j, closed = literal_end(s, i)
            out += [s[i:j]] if closed else []
            i = j
        else:
            i += 1
    return out


def model_tokens(s: str) -> int:
    n, inside = 0, False
    for c in s:
        word = c.isascii() and (c.isalnum() or c in "_$") or not c.isascii()
        n += (word and not inside) or (not word and c not in " \t\n\f\r")
        inside = word
    return n


ALPHABETS = [
    ['"', "\\", "a", " ", "'", "\n", "\r", "/", "*", "é", "1"],
    ['"', "\\\\", '\\"', "x", "'", " ", "//", "/*", "*/", "\n", "{", "漢"],
    ["\\u0022", "\\u0041", "\\U0027", "\\u00e9", "\\", "u", "0", '"', "'", "\0", "\r\n", "\x0b", "\xa0"],
]


@pytest.fixture(scope="module")
def fuzzed(spark):
    rng = random.Random(7)
    made = ["".join(rng.choices(rng.choice(ALPHABETS), k=rng.randint(0, 24))) for _ in range(6000)]
    made += ["", "'\\''", "'\"'\nx", "/* open \"", "/* open", "\"never closed", "a\\\\\"b\"", "größe größe", '"a" + "b"', "x" * 50_000, '"' + '\\"' * 20_000]
    return made


@pytest.mark.parametrize(
    ("column", "model"),
    [
        (repair.drop_nul_and_cr, model_nul),
        (repair.unescape_unicode, model_unicode),
        (repair.unescape_apostrophes, model_apostrophes),
        (repair.escape_line_breaks, model_line_breaks),
        (repair.collapse_backslashes, model_backslashes),
        (repair.repair, lambda s: model_line_breaks(model_apostrophes(model_unicode(model_nul(s))))),
        (repair.repair_all, lambda s: model_backslashes(model_line_breaks(model_apostrophes(model_unicode(model_nul(s)))))),
        (literals.blank_for_good, model_blank),
        (lambda c: literals.blank(c)["out"], lambda s: model_mask(s)[0]),
        (lambda c: literals.restore(literals.blank(c)["out"], literals.blank(c)["store"]), lambda s: model_restore(*model_mask(s))),
        (count_tokens, model_tokens),
        (literals.closed_literals, model_closed),
        (repair.strip, str.strip),
    ],
)
def test_against_model(spark, fuzzed, column, model):
    short = [s for s in fuzzed if len(s) < 30_000] if model.__name__ in ("<lambda>",) else fuzzed
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(short)], "i int, s string")
    got = {r[0]: r[1] for r in rows.select("i", column(F.col("s"))).collect()}
    wrong = [(s, got[i], model(s)) for i, s in enumerate(short) if got[i] != model(s)]
    assert not wrong, wrong[:3]


def test_spans_give_the_literals(spark, fuzzed):
    short = [s for s in fuzzed if len(s) < 1000]
    rows = spark.createDataFrame([(s,) for s in short], "s string").select("s", literals.literal_spans(F.col("s")).alias("x")).collect()
    assert all([r.s[a:b] for a, b in r.x] == model_closed(r.s) for r in rows)


def test_take_literals(spark):
    rows = spark.createDataFrame([('f("a", "b")', 'g("x") + h("y")'), ('"a"', "none"), ("", ""), (None, '"a"')], "p string, r string")
    assert [r[0] for r in rows.select(literals.take_literals(F.col("p"), F.col("r"))).collect()] == ['g("a") + h("b")', None, "", None]


def test_nulls_stay_null(spark):
    row = spark.createDataFrame([(None,)], "s string")
    c = F.col("s")
    for column in (repair.repair_all(c), literals.blank_for_good(c), literals.blank(c), literals.closed_literals(c), count_tokens(c), literals.identifier(c), literals.literal_spans(c)):
        assert row.select(column).first()[0] is None


def test_placeholder_in_a_comment_is_replaced_first(spark):
    src = "/* \"STR_0\" */ \"a\""
    row = spark.createDataFrame([(src,)], "s string").select(literals.blank(F.col("s")).alias("m"))
    assert row.select(literals.restore(F.col("m.out"), F.col("m.store"))).first()[0] == "/* \"a\" */ \"STR_0\""


def test_identifier(spark):
    rows = spark.createDataFrame([("größe",), ("élan",), ("  a$1+b",), ("é",), ("",)], "s string")
    assert [r[0] for r in rows.select(literals.identifier(F.col("s"))).collect()] == ["gr", "lan", "a$1", None, None]


def test_large_texts_take_time_in_proportion(spark):
    """5 MB with 100,000 literals: masked, restored, found and exchanged."""
    import time

    src = "".join(f'f("literal number {k}", \'c\'); // it\'s "{k}\n' for k in range(100_000))
    df = spark.createDataFrame([(src,)], "s string").persist()
    df.count()
    began = time.perf_counter()
    mask = literals.blank(F.col("s"))
    same = df.select("s", mask.alias("m")).select((literals.restore(F.col("m.out"), F.col("m.store")) == F.col("s")).alias("same"), F.size("m.store").alias("n"))
    assert tuple(same.first()) == (True, 200_000)
    # Without regard for comments a literal ends where the next line's begins, and so on.
    spans = model_closed(src)
    assert df.select(F.size(literals.literal_spans(F.col("s")))).first()[0] == len(spans)
    assert df.select(literals.take_literals(F.col("s"), F.col("s")) == F.col("s")).first()[0]
    assert time.perf_counter() - began < 60
    df.unpersist()
