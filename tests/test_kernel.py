"""The Python kernel: lexer, signatures, diffs, replies."""

from __future__ import annotations

import difflib
import json
import random

import pytest

from fissure.functions import diffs, lexer, replies, scopes, signatures


@pytest.mark.parametrize(("language", "source", "n"), [
    ("c", "int a() { return 1; }\nint b(void)\n{\n  if (x) { y(); }\n}\nstatic void c(int q) { for (;;) { } }", 3),
    ("cpp", "class A { public: int f() { return 1; } void g() const { } int h; };", 2),
    ("cpp", "class A { public: int f() { return 1; } };", 1),
    ("c++", "A::A() : x{1}, y(2) { } A::~A() { } A(const A&) = default; A& operator=(const A& o) { return *this; }", 4),
    ("c", "struct s { int a; }; int x[] = {1, 2}; enum e { A, B }; int f(void);", 0),
    ("c", '#define F(x) { x }\nconst char *s = "int f() { }"; /* int g() { } */ int h() { return \'{\'; }', 1),
    ("c", "namespace n { extern \"C\" { int f() { auto l = [](int a) { return a; }; return 1; } } }", 1),
    ("java", "class A { A() { } int f(int a) { return a; } }", 2),
    ("java", "interface I { void f(); default int g() { return 1; } } abstract class B { abstract void h(); int x = k(1); }", 3),
    ("java", "enum E { A(1), B(2); E(int i) { } }  class C { @Anno(a = \"{\") void m() { Runnable r = new Runnable() { public void run() { } }; } static { init(); } }", 3),
    ("java", 'class A { String s = """\n void f() { }\n"""; void g() { } }', 1),
    ("c", "", 0), ("c", "  \n", 0), ("c", "int x;", 0), ("python", "def f(): pass", -1), ("", "int a() { }", -1), (None, "x", -1),
])
def test_function_count(language, source, n):
    assert scopes.count_functions(source, language) == n


@pytest.mark.parametrize(("language", "source", "out"), [
    ("c", "int a; // x\n\n\n/* y\n z */ int b;\n", "int a; \n\n int b;"),
    ("java", "/** doc\n * @param x */\nint a;", "int a;"),
    ("c", 's = "// no"; c = \'"\'; t = "/* no */"; // yes', 's = "// no"; c = \'"\'; t = "/* no */"; '),
    ("cpp", 'r = R"d(// no )" )d"; x = 1\'000\'000; // yes\ny', 'r = R"d(// no )" )d"; x = 1\'000\'000; \ny'),
    ("java", 't = """\n// no "x"\n"""; // yes', 't = """\n// no "x"\n"""; '),
    ("c", "a // one \\\n two\nb", "a \nb"),
    ("c", "a /* open\nb", "a "),
    ("c", "a\n\n\nb", "a\n\n\nb"), ("python", "# x\n// y", "# x\n// y"), ("", "a // b", "a // b"), ("c", "", ""), ("c", None, None), ("c", "// only", ""),
])
def test_comments(language, source, out):
    assert lexer.remove_comments(source, language) == out


@pytest.mark.parametrize(("language", "source", "out"), [
    ("c", "static inline char *f(int a,\n  char  b)\n{", "f(int a, char b) -> char *"),
    ("c", "#include <x>\nif (a) { }\n// no(\nunsigned long g(void);", "g(void) -> unsigned long"),
    ("cpp", "auto f(int a) -> std::vector<int> {", "f(int a) -> std::vector<int>"),
    ("java", "public static void main(String[] args) {", "main(String[] args) -> void"),
    ("python", "@x\ndef f(a ,\n b=1) -> int:\n", "f(a, b=1) -> int"),
    ("ruby", "def ok?(a)\nend", "ok?(a)"),
    ("go", "func (s *T) Do(a int) (int, error) {", "T.Do(a int) -> (int, error)"),
    ("rust", "fn f<T>(a: T) -> Vec<T> where T: X {", "f(a: T) -> Vec<T>"),
    ("php", "public function f($a): int {", "f($a) -> int"),
    ("JavaScript", "async function f(a, b) {", "f(a, b)"), ("typescript", "get(a: number): string {", "get(a: number) -> string"),
    ("text", "// note\n  hello \\ world\n", "hello \\\\ world()"), ("c", "", ""), ("c", None, ""), ("zig", "// only", ""),
])
def test_signature(language, source, out):
    assert signatures.signature(source, language) == out


def test_hunks():
    assert diffs.hunks("a\nb\nc\nd\ne\nf\ng", "a\nb\nc\nX\ne\nf\ng") == ([["b", "c", "X", "e", "f"]], [["b", "c", "d", "e", "f"]])
    assert diffs.hunks("", "a") == ([], []) and diffs.hunks("a", "a") == ([], [])
    assert diffs.changed_lines("a\nb\nc", "a\nX\nc\nd") == ([2, 4], [2], [(2, 3, 2, 3)])


def test_optimized():
    before = "\n".join(f"l{i}" for i in range(60))
    after = before.replace("l10\n", "L10\n").replace("l12\n", "").replace("l50", "L50")
    out = diffs.optimized(before, after, 3)
    assert out["vulnerable_code"].split("\n")[3] == ">>>   11 | l10" and "\n...\n" in out["vulnerable_code"] and out["changed_line_count"] == 2
    assert out["reduction_ratio"] == 1 - out["optimized_size"] / out["original_size"]
    same = diffs.optimized("x" * 300, "x" * 300)
    assert same["optimized"] and same["reduction_ratio"] == 0.9 and same["vulnerable_code"] == "x" * 200 + "..." and same["original_size"] == 600
    assert not diffs.optimized("", "x")["optimized"] and diffs.optimized(None, None)["original_size"] == 0
    added = diffs.optimized("\n".join("abcdefghijklmnop"), "\n".join("abcdefghijklmnopQ"), 2)
    assert added["vulnerable_code"].split("\n")[2] == "..." and added["vulnerable_code"].startswith("      1 | a")


def test_unified():
    r = random.Random(0)
    for _ in range(50):
        a, b = ("\n".join(r.choice("abcde") for _ in range(r.randint(1, 90))) for _ in range(2))
        want = "\n".join(difflib.unified_diff(a.splitlines(keepends=True), b.splitlines(keepends=True), "vulnerable.c", "fixed.c", lineterm="", n=3)) or "No changes detected"
        assert diffs.unified(a, b) == want
        assert len(diffs.compact(a, b).splitlines()) <= 50
    assert diffs.unified("", "x") == ""


def test_patch_lines():
    patch = "diff --git a/x b/x\n+++ b/x\n@@ -1 @@\n-nothing\n+int f() {\n+more\n@@ -9 @@\n-late\ndiff --git a/y b/y\n@@ -1 @@\n+other"
    assert diffs.lines_from_patch(patch, "int f() {\n  body\n}") == [["int f() {", "more"], ["late"]]
    assert diffs.lines_from_patch(patch, None) == [] and diffs.lines_from_patch("", "x") == []


@pytest.mark.parametrize(("message", "out"), [
    ('[{"lang": "zh", "value": "Z"}, {"lang": "en", "value": " E "}]', "E"), ("[{'lang': 'en', 'value': 'P'}]", "P"), ('[{"lang": "en", "value": ""}, {"lang": "fr", "value": "F"}]', "F"),
    ("[]", None), (None, None), ("  ", None), ("[1, 2]", None), ("[invalid json", "[invalid json"), ('{"a": 1}', '{"a": 1}'), (" plain ", "plain"),
])
def test_messages(message, out):
    assert replies.clean_message(message) == out


def test_replies():
    assert replies.parse_reply('{"a": 1}') == '{"a": 1}'
    assert replies.parse_reply('x ```json\n{"a": {"b": 2}}\n``` y') == '{"a": {"b": 2}}'
    assert replies.parse_reply('x {"a": {"b": 2}} y }') == '{"a": {"b": 2}}'
    assert replies.parse_reply("nothing") is None and replies.parse_reply("{broken") is None and replies.parse_reply(None) is None


def test_review_rules():
    good = {"vulnerability_analysis": {"summary": "s" * 300, "severity": "HIGH", "root_cause": "CWE-79", "attack_vector": "a", "cwe_explanation": "e", "affected_lines": [1]}, "fix_analysis": {"summary": "s", "changes_made": [], "fix_quality": "GOOD", "completeness": "COMPLETE"}, "code_review": {"security_improvements": [], "remaining_concerns": [], "best_practices": []}}
    assert replies.issues(good) == {} and replies.confidence(good, "CWE-79") == 1.0
    bad = json.loads(json.dumps(good))
    bad["vulnerability_analysis"]["severity"] = "high"
    del bad["fix_analysis"]["summary"]
    bad["code_review"]["best_practices"] = "sorry"
    assert replies.issues(bad) == {"vulnerability_analysis": ["Invalid severity: high"], "fix_analysis": ["Missing fields: summary"], "code_review": ["best_practices must be a list"]}
    assert replies.confidence(bad, "CWE-1") == pytest.approx(1 - 0.25 - 0.15 - 0.1 - 0.05)
    assert replies.confidence({}, "X") == pytest.approx(0.03 + 0.1)


def test_sql_values():
    assert replies.sql_values("INSERT INTO fixes VALUES('CVE-1','it''s, (x)',NULL,7,replace('a\\nb','\\n',char(10)),'None');") == ["CVE-1", "it's, (x)", None, "7", "a\nb", None]
    assert replies.sql_values("CREATE TABLE x") == []
    assert replies.description("[{'lang': 'en', 'value': 'D'}]") == "D" and replies.description("[{'lang': 'en', 'value': 'it's'}]") == "[{'lang': 'en', 'value': 'it's'}]"
