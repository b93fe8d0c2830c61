"""The parser of scopes: what counts as a function, in every place where a brace may open."""

from __future__ import annotations

import random
import time

import pytest

from fissure.functions.scopes import count_functions
from fissure.plans.rows import COUNTED

C = [
    # shapes of definitions
    ("int add(int a, int b) {\n return a + b;\n}\nint subtract(int a, int b) {\n return a - b;\n}", 2),
    ("struct foo *f(struct bar *a) { return 0; } enum e g(void) { return A; } const struct x h(int a) { struct x y = { 1 }; return y; }", 3),
    ("void (*signal(int sig, void (*func)(int)))(int) { return 0; }", 1),
    ("int (*table[])(void) = { f, g }; struct ops o = { .open = f, .read = g }; int a[2][2] = { { 1 }, { 2 } };", 0),
    ("__attribute__((constructor)) static void f(void) { } int g(void) __attribute__((noinline)) { return 1; }", 2),
    ("TEST(Foo, Bar) { EXPECT(1); } SYSCALL_DEFINE3(read, int, fd) { return 0; }", 2),
    ("static DEFINE_MUTEX(lock);\nEXPORT_SYMBOL(f)\nstatic int x;\nint g(void) { return 1; }", 1),
    ("typedef struct { int x; } t; union u { int a; float b; }; enum { A = f(1), B };", 0),
    ("int f(void) { struct local { int x; } y = { 1 }; return ((struct local) { 2 }).x; }", 1),
    # the old style
    ("int main(argc, argv)\nint argc;\nchar **argv;\n{\n return 0;\n}", 1),
    ("f(a) unsigned a; { if (a) { g(a); } }\nint h() { return 1; }", 2),
    ("int f(a, b);\nint x;\nint g(int a) { return a; }", 1),
    # the preprocessor
    ("#include <x.h>\n#define F(x) { \\\n x \\\n}\nint f(void) { return 1; }", 1),
    ("void f(void) {\n#if X\n if (a) {\n#elif Y\n if (b) {\n#else\n if (c) {\n#endif\n d(); }\n}\nvoid g(void) { }", 2),
    ("#ifdef A\nint f(int a) {\n#else\nint f(long a) {\n#endif\n return 0; }\nint g(void) { return 1; }", 3),
    ("#if A\n#if B\nint f() { }\n#else\nint g() { }\n#endif\n#else\nint h() { }\n#endif\n#endif\n#else\nint i() { }", 4),
    # broken code
    ("} } ) ] int f(void) { } }", 1), ("int f(void) { if (a { b(); } }\nint g(void) { }", 2), ("int f(void) {\n while (1) {\n", 1), ("if (x) { y(); } for (;;) { } return f(x);", 0), ("int f(", 0), ("f() { g(", 1),
    # C++
    ("class A { public: A() : x{1}, y(2), z([]{ return 1; }) { } explicit A(int) : B<int>{1} { } ~A() { } private: int x : 3; };", 3),
    ("struct A { A() = default; A(const A&) = delete; virtual void f() = 0; int g() const noexcept override { return 1; } };", 3),
    ("bool operator<(A a, A b) { return 1; } A& operator=(const A&) { } A operator()(int a) { } operator bool() const { return 1; } void* operator new[](size_t n) { return 0; }", 5),
    ("template <class T, int N = (1 > 2)> class A { template <typename U> void f(U u) { } }; template <> struct B<int> { };", 1),
    ("template <typename T> auto f(T t) -> std::vector<T> { return {}; } [[nodiscard]] int g() { return 1; }", 2),
    ("namespace a::b { namespace { extern \"C\" { void f() { } } extern \"C\" void g() { } } } using namespace a;", 2),
    ("A::A() try : x(1) { } catch (...) { }", 1), ("class EXPORT(x) A : public B<int> { int f() { return 1; } };", 1), ("class Q { Q_OBJECT public slots: void f() { } signals: void g(); };", 1),
    ("auto f = [](int a) { return a; }; int x{1}; std::vector<int> v{1, 2};", 0),
    ("int main() { auto l = [&](auto x) { struct S { int f() { return 1; } }; return x; }; run([] { return 1; }); }", 2),
]
JAVA = [
    ('class A { @SuppressWarnings({"a", "b"}) public void f() { } @Foo(bar = {1, 2}, baz = @Qux({3})) int g() { return 1; } @a.b.C("x") @Override void h() { } }', 3),
    ('@interface A { String[] value() default {"a"}; int n() default 1; } class B { @A({"x"}) int[] xs = {1, 2}; @A int f() { return 1; } }', 1),
    ("class A { int[] f() { return new int[] {1, 2}; } int[][] a = {{1}, {2}}; int[] b = new int[]{f(1)}, c = g(new int[]{2}); }", 1),
    ("class A { Runnable r = () -> { run(); }; Runnable s = new Runnable() { public void run() { } }; void f() { g(new Runnable() { public void run() { } }, x -> { }); } }", 3),
    ("enum E { A(1) { int v() { return 1; } }, @Deprecated B(2); E(int i) { } abstract int v(); }", 3),
    ("record P(int x) { P { if (x < 0) { throw new E(); } } static int f() { return 1; } } class R { void record() { } record() { } }", 3),
    ("interface I { void a(); default int b() { return 1; } static <T extends X<Y>> T c(T x) { return x; } int K = f(1); }", 3),
    ("class A { static { init(); } { x = 1; } A() throws E { this(1); } native void f(); abstract List<Map<K, V>> g(Map<K, List<V>> m) throws E; }", 3),
    ("class A { void f() { class L { void g() { } } int x = switch (y) { case 1 -> { yield 2; } default -> 3; }; synchronized (this) { for (A a : new B()) { } } } }", 2),
    ("public int f() { return 1; }\nif (x) { foo(1); }\nelse bar(2);\nreturn baz(3);\nObject o = new Foo(1);", 1),
    ("class A { void f() { if (a { b(); } }\n void g() { } } } class B { void h() { } }", 3),
    ("public class UserService { private Map<String, User> m = new HashMap<>(); public User get(String id) { return m.get(id); } }", 1),
]


@pytest.mark.parametrize(("language", "code", "n"), [*(("cpp", *x) for x in C), *(("java", *x) for x in JAVA), *COUNTED])
def test_functions(language, code, n):
    assert count_functions(code, language) == n


@pytest.mark.parametrize("language", ["c", "C", "c++", "C++", "cpp", "Cpp", "CPP", "c/c++", "C/C++", " c "])
def test_language_names(language):
    assert count_functions("int func() { return 0; }", language) == 1


@pytest.mark.parametrize("language", ["java", "Java", "JAVA"])
def test_java_names(language):
    assert count_functions("public class A { public void m() {} }", language) == 1


def test_nothing_and_other_languages():
    assert [count_functions(x, "c") for x in ("", "  \n\t ", None, "int x = 1;\nint y = 2;")] == [0, 0, 0, 0]
    assert count_functions("def f(): pass", "python") == -1 and count_functions("int f() { }", "") == -1 and count_functions("int f() { }", None) == -1


def test_any_text_is_read():
    r = random.Random(1)
    parts = ["{", "}", "(", ")", "[", "]", "<", ">", ";", ":", "=", ",", "@", "->", "int ", "f", "new ", "class ", "template ", "enum ", "operator", "record ", '"', "'", "//", "/*", "*/", "\n#if\n", "\n#else\n", "\n#endif\n", "default", "\\", "\n"]
    for _ in range(4000):
        code = "".join(r.choice(parts) for _ in range(r.randint(1, 40)))
        assert all(count_functions(code, x) >= 0 for x in ("c", "java"))


@pytest.mark.parametrize("code", ["{" * 200_000, "(" * 200_000 + ")" * 200_000, "int f() {\n#if A\n" * 30_000, "template<" * 100_000, "A() : " + "a{1}, " * 50_000 + "b(1) { }", "#if A\n{\n#else\n}\n#endif\n" * 30_000, "@A" * 100_000 + "(", "int f(a) " + "int a; " * 100_000 + "{ }"])
def test_time_is_linear(code):
    began = time.monotonic()
    count_functions(code, "c")
    count_functions(code, "java")
    assert time.monotonic() - began < 20
