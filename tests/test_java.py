"""The recogniser and the renamer on exact texts."""

import re

import pytest

from lexiquarry.operators import rename as R
from lexiquarry.operators.javalex import tokens

SOUND = [
    "",
    "package a.b; import static a.B.*; import c.D;",
    "class A<T extends B & C<D>> extends E<T> implements F, G { }",
    "int x = 1;",
    "void f() { }",
    "@Test public void f() throws Exception { a(); }",
    "class A { { init(); } static { init(); } A() { this(1); } <T> A(T t) { super(t); } ; }",
    "interface I { int C = 1; void f(); default int g() { return 1; } static void h() { } }",
    "enum E { A, B(1) { void f() { } }, ; private int v; E(int... v) { } }",
    "enum E { A, B }",
    '@interface N { String value() default "_"; int[] q() default {1, 2}; }',
    "record P(int a, List<String> b) implements Q { P { check(a); } P(int a) { this(a, null); } static int f() { return 1; } }",
    "sealed interface S permits A, B { } non-sealed class A implements S { }",
    "void f() { List<Map<String, List<int[]>>> x = new ArrayList<>(); }",
    "void f() { int[] a = {1, 2, }, b[] = {{1}, {}}; int[][] c = new int[3][]; long[] d = new long[]{1L}; }",
    "void f() { x = (int) y + (String) z + (a) + (b) - c; q = (Runnable & Serializable) () -> { }; }",
    "void f() { g(x -> x, (a, b) -> a + b, (int p, final String q) -> { return p; }, A::new, int[]::new, List<String>::size, this::f, super::g); }",
    "void f() { if (a) b(); else if (c) { d(); } else ; while (x) y(); do { z(); } while (q); }",
    "void f() { for (;;) { break; } for (int i = 0, j = 1; i < j; i++, j--) { continue; } for (final var x : xs) { } for (i = 0; ; ) ; }",
    "void f() { try (A a = b(); c; d.e) { } try { } catch (final A | B e) { } finally { } }",
    "int f(int x) { switch (x) { case 1: case A.B: g(); break; default: h(); } return switch (x) { case 1, 2 -> 3; case 4 -> { yield 5; } default -> throw new E(); }; }",
    "void f(Object o) { if (o instanceof A a && a.b() || o instanceof final C c || o instanceof D) { } switch (o) { case A a when a.b() -> { } case P(int x, var y) -> { } default -> { } } }",
    "void f() { outer: while (true) { break outer; } assert x : \"_\"; synchronized (this) { } throw new E(\"_\") { }; }",
    "void f() { a <<= 1; b >>>= 2; c = d >> e >>> g; h = i < j == k > l; m = n ? o : p ? q : r; }",
    "void f() { a.b().c[1].<T>d(e)[2]++; A.this.b(); int.class.x(); a.new B(); String[].class.y(); }",
    "void f() { class L { int x; } record R(int a) { } @A final int y = 1; yield(1); var record = 2; }",
    "<T> T f(@N T t, int... r)[] { return null; }",
    "/* c */ // d\nclass A { char c = '\\n', d = '\\u0041', e = '\\''; String s = \"\"\"\n a \"b\" \"\"\"; double g = 1e-3 + .5f + 0x1p3 + 1_000L; }",
]
BROKEN = [
    'void f() { String s = "_" x "_"; }',
    "class A { void f() { }",
    "class A { } }",
    "void f() { int x = ; }",
    "void f() { g(; }",
    "void f() { a b c; }",
    'void f() { x = "_" b \\\\"_"; }',
    "void f() { '' }",
    'void f() { s = "open; }',
    "class { }",
    "void f() { #; }",
    "void f() { if a { } }",
    "void f() { try { } }",
    "void f() { foo(a, ); }",
    "class A { int x }",
]


@pytest.mark.parametrize("source", SOUND)
def test_sound(source):
    assert not R.has_errors(source)


@pytest.mark.parametrize("source", BROKEN)
def test_broken(source):
    assert R.has_errors(source)


CASES = [
    ("class A { void a() { b(); } void b() { a(); } }", "class A { void func_1() { b(); } void func_2() { a(); } }"),
    ("int f(int x) { x++; { int x1 = x; } return x; }", "int func_1(int var_1) { var_1++; { int var_2 = var_1; } return var_1; }"),
    ("void f() { int x = x + 1, y = x; }", "void func_1() { int var_1 = var_1 + 1, var_2 = var_1; }"),
    ("class A { int a; int b; A(int a) { this.a = a; b = a; } int f(int b) { return a + b + this.a; } }",
     "class A { int var_1; int var_2; A(int a) { this.a = a; b = a; } int func_1(int var_3) { return var_1 + var_3 + this.a; } }"),
    ("class A { int n; } class B { int n; int f() { return n; } }", "class A { int var_2; } class B { int var_2; int func_1() { return var_2; } }"),
    ("void f() { for (int i = 0; i < 3; i++) g(i); for (X i : i) g(i); }", "void func_1() { for (int var_1 = 0; var_1 < 3; var_1++) g(var_1); for (X var_2 : var_2) g(var_2); }"),
    ("void f() { h(x -> x, (a, b) -> a + b, (T c) -> c); }", "void func_1() { h(x -> x, (var_1, var_2) -> var_1 + var_2, (T var_3) -> var_3); }"),
    ("void f() { try (R r = o()) { r.a(); } catch (E e) { e.p(); } r.b(); }", "void func_1() { try (R var_1 = o()) { var_1.a(); } catch (E e) { e.p(); } var_1.b(); }"),
    ("void f(int x) { A a = new A() { int g() { int y = x; return y; } }; }", "void func_1(int var_1) { A var_2 = new A() { int func_2() { int var_4 = var_1; return var_4; } }; }"),
    ("class C { int y; void f(int x) { new A() { void g() { int z = x; } }; } }", "class C { int var_1; void func_1(int var_2) { new A() { void func_2() { int var_4 = var_2; } }; } }"),
    ("class C { int x; void f(int x) { new A() { int g() { return x; } }; } }", "class C { int var_1; void func_1(int var_2) { new A() { int func_2() { return var_1; } }; } }"),
    ("void f(int g) { new A() { void g() { g(); } }; }", "void func_1(int var_1) { new A() { void func_2() { g(); } }; }"),
    ("void f(int... a) { int b = a[0]; }", "void func_1(int... a) { int var_1 = a[0]; }"),
    ("void f() { int größe = 1; größe++; }", "void func_1() { int var_1öße = 1; var_1öße++; }"),
    ("interface I { int C = 1; int f(int C); }", "interface I { int C = 1; int func_1(int var_1); }"),
    ("void f() { Map<K, V> k = null; K.of(k.k, V.v); }", "void func_1() { Map<K, V> var_1 = null; K.of(var_1.k, V.v); }"),
]


@pytest.mark.parametrize(("source", "want"), CASES)
def test_rename(source, want):
    assert R.rename(source) == (False, want)


@pytest.mark.parametrize("source", SOUND)
def test_only_names_change(source):
    _, out = R.rename(source)
    a, b = tokens(source), tokens(out)
    assert len(a) == len(b)
    assert all(x.text == y.text or re.fullmatch(r"(func|var)_\d+.*", y.text) for x, y in zip(a, b, strict=True))


def test_broken_text_is_renamed_as_far_as_it_goes():
    broken, out = R.rename('class A { void f() { int a = 1; x y z; int b = a; } void g() { int c = 2; } }')
    assert broken
    assert out == "class A { void func_1() { int var_1 = 1; x y z; int var_2 = var_1; } void func_2() { int var_3 = 2; } }"


def test_deep_nesting_is_an_error_not_a_crash():
    assert R.has_errors("void f() { x = " + "(" * 5000 + "1" + ")" * 5000 + "; }")


N = 2_000
DEEP = [
    ("void f(int a) { " + " else ".join(f"if (a == {k}) b();" for k in range(20_000)) + " else { int q = a; } }", "{ int var_2 = var_1; } }"),
    ("void f(int a) { int q = " + " ".join(f"a == {k} ? {k} :" for k in range(20_000)) + " a; }", ": var_1; }"),
    ("void f(int a) { int q = " + "(" * N + "a" + ")" * N + "; }", "(var_1" + ")" * N + "; }"),
    ("void f(int a) { int q = " + "g(" * N + "a" + ")" * N + "; }", "(var_1" + ")" * N + "; }"),
    ("void f(int a) { " + "{ " * N + "int q = a; " + "}" * N + " }", "{ int var_2 = var_1; " + "}" * N + " }"),
    ("void f(int a) { " + "if (a) " * N + "a++; }", "if (var_1) var_1++; }"),
    ("void f(int a) { X q = " + "y -> " * N + "a; }", "y -> var_1; }"),
    ("void f(int a) { int[] q = " + "{" * N + "a" + "}" * N + "; }", "{var_1" + "}" * N + "; }"),
    ("class A { " * N + "int x;" + " }" * N, "class A { int var_1;" + " }" * N),
]


@pytest.mark.parametrize(("source", "end"), DEEP)
def test_long_chains_and_deep_nesting_are_sound(source, end):
    broken, out = R.rename(source)
    assert not broken and out.endswith(end)


def test_broken_deep_text_is_renamed_as_far_as_it_goes():
    broken, out = R.rename("void f(int a) { " + "{" * N + " x y z; int q = a; " + "}" * (N - 1) + " } } void g() { int r; }")
    assert broken and out.endswith("void func_2() { int var_3; }")


def test_a_dangling_else_belongs_to_the_inner_if():
    assert not R.has_errors("void f() { if (a) if (b) c(); else if (d) e(); else g(); else h(); }")
    assert R.has_errors("void f() { if (a) b(); else c(); else if (d) e(); }")
