"""Function definitions of C, C++ and Java code, by an error-tolerant parser of nested scopes.

The parser is an island grammar: it knows declarations, bodies, types and initialisers, and skips the rest. It keeps a stack of open braces, parentheses and template brackets, each with what stands at its level since the last
declaration ended: words in parentheses or braces of their own are one item there. A brace opens a type, a body or a value by the items before it.

Recovery: a closing brace ends the parentheses that were left open inside; a closing parenthesis or brace that nothing has opened is skipped; an end of file ends everything. Each alternative of ``#if`` is read from the place where ``#if`` stood, and
the first one's end is where reading goes on, so that every alternative's functions count and none of their braces are missed or doubled.

Counted are: in C and C++ definitions with a body, ``= default`` and ``= delete``; heads of the old style, with declarations of the parameters before the body, as one; in Java methods and constructors, methods without a body too, but not
elements of annotation types. Lambdas, initialiser blocks and compact constructors of records don't count.
"""

from __future__ import annotations

import re

from fissure.functions.lexer import CONTROL, TOKEN, bare, family

WORD = re.compile(r"[^\W\d]")
#: Words before a parenthesis that does not hold parameters.
NOT_NAMES = CONTROL | {"__attribute__", "__declspec", "alignas", "_Alignas", "noexcept", "throw", "requires", "asm", "__asm__", "explicit", "typeof", "__typeof__"}
TYPES = {"c": {"class", "struct", "union", "namespace", "enum"}, "java": {"class", "interface", "enum", "record"}}
LABELS = {"public", "private", "protected", "signals", "slots", "Q_SIGNALS", "Q_SLOTS"}
#: Marks that stand for the lines of a preprocessor's alternatives.
IF, ELSE, ENDIF = "\x01", "\x02", "\x03"
_LINE = re.compile(r"(?m)^[ \t]*#[ \t]*(\w*)(?:[^\n\\]|\\\r?\n|\\.)*")
_MARK = {"if": IF, "ifdef": IF, "ifndef": IF, "else": ELSE, "elif": ELSE, "elifdef": ELSE, "elifndef": ELSE, "endif": ENDIF}
_TOKENS = re.compile(f"[{IF}{ELSE}{ENDIF}]|" + TOKEN.pattern)


class Level:
    """An open bracket and what has been read at its level since the last declaration ended."""

    __slots__ = ("kind", "outer", "n", "last", "before", "call", "named", "plain", "assign", "typed", "control", "operator", "colon", "fresh", "default", "annotation", "old")
    #: kind: scope, enum, annotation, block, value, ( or <

    def __init__(self, kind: str, outer: Level | None):
        self.kind, self.outer, self.old, self.annotation = kind, outer, False, 0
        self.clear()

    def clear(self) -> None:
        self.n, self.last, self.before, self.typed = 0, "", "", ""
        self.call = self.named = self.plain = self.assign = self.control = self.operator = self.colon = self.fresh = self.default = False

    def copy(self) -> Level:
        other = Level.__new__(Level)
        for name in Level.__slots__:
            setattr(other, name, getattr(self, name))
        return other


class Parser:
    def __init__(self, kind: str):
        self.kind, self.types, self.count = kind, TYPES[kind], 0
        self.top = Level("scope", None)
        #: Open alternatives: where each began, and where its first one ended.
        self.alternatives: list[tuple[Level, Level | None]] = []

    def push(self, kind: str) -> None:
        self.top = Level(kind, self.top)

    def pop(self) -> None:
        # what is outside may also be the start of another alternative, so it is not changed in place
        self.top = self.top.outer.copy()

    def item(self, t: str) -> None:
        """A word, mark or closed bracket becomes the last item of the level."""
        top = self.top
        top.n += 1
        top.before, top.last = top.last, t

    def read(self, code: str) -> int:
        for t in _TOKENS.findall(code):
            if t in (IF, ELSE, ENDIF):
                self.alternative(t)
            elif t == "{":
                self.opened()
            elif t == "}":
                self.closed()
            elif t == ";":
                self.ended()
            else:
                self.token(t)
        return self.count

    def alternative(self, t: str) -> None:
        if t == IF:
            self.alternatives.append((self.top, None))
            self.top = self.top.copy()
        elif self.alternatives:
            start, end = self.alternatives[-1]
            if t == ELSE:
                self.alternatives[-1] = (start, end or self.top)
                self.top = start.copy()
            else:
                self.alternatives.pop()
                self.top = (end or self.top).copy()

    def token(self, t: str) -> None:
        top, java = self.top, self.kind == "java"
        if top.annotation:
            if top.annotation == 1:
                # the name behind @, or behind a dot of it
                top.annotation = 2
                if t == "interface":
                    top.annotation, top.typed = 0, "annotation"
                return
            if t == ".":
                top.annotation = 1
                return
            top.annotation = 0
            if t == "(":
                self.push("(")
                self.top.kind = "annotation("
                return
        if t == "@" and java:
            top.annotation = 1
        elif t in "([":
            self.push(t)
        elif t in ")]":
            while self.top.kind == "<":
                self.pop()
            if self.top.kind in ("(", "[", "annotation("):
                inner = self.top
                self.pop()
                if inner.kind == "[":
                    self.item("[]")
                elif inner.kind == "(":
                    self.parenthesis(inner)
        elif t == "<" and not java and top.last == "template":
            self.push("<")
        elif t == "<" and top.kind == "<":
            self.push("<")
        elif t == ">" and top.kind == "<":
            self.pop()
            if self.top.kind != "<":
                self.top.clear()
        else:
            self.word(t)

    def parenthesis(self, inner: Level) -> None:
        """Parentheses are closed: are they the parameters of what stands before?"""
        top = self.top
        name = top.last
        if top.kind in "([":
            top.plain = False
        if name == top.typed == "record":
            top.typed = ""
        if not top.call and not top.assign and top.n:
            if name == "operator":
                pass
            elif top.operator or (WORD.match(name) and name not in NOT_NAMES and not (self.kind == "c" and top.before in TYPES["c"] and top.n <= 2)):
                if not top.control and not (top.fresh and self.kind == "java"):
                    top.call, top.plain = True, inner.plain and inner.n > 0
                    top.named = bool(re.match(r"[\w>]|\[\]", top.before)) and top.before not in CONTROL
        self.item("()")

    def word(self, t: str) -> None:
        top = self.top
        if top.kind in "([":
            top.plain = (top.plain or not top.n) and (t == "," or bool(WORD.match(t)) and top.last in ("", ","))
        if not top.call:
            if t in self.types and not top.assign and top.last != ".":
                top.typed = top.typed or t
            elif t in CONTROL and not top.operator:
                top.control = True
            elif t == "operator":
                top.operator = True
            elif t == "=" and top.last != "operator":
                top.assign = True
        elif t == ":" and self.kind == "c":
            top.colon = True
        elif t == "default":
            top.default = True
        if t == "new":
            top.fresh = True
        elif t in (",", "=", "->", "return") and not top.call:
            top.fresh = False
        if t == ":" and top.n == 1 and top.last in LABELS or t == ":" and top.n == 2 and top.before in LABELS:
            top.clear()
        else:
            self.item(t)

    def opened(self) -> None:
        while self.top.kind == "<":
            self.pop()
        top = self.top
        top.annotation = 0
        kind = self.java() if self.kind == "java" else self.c()
        if kind == "function":
            self.count += 1
            kind = "block"
        self.push(kind)
        if kind != "value":
            top.old = False

    def c(self) -> str:
        top = self.top
        typed = "value" if top.typed == "enum" else "scope"
        if top.kind != "scope":
            return typed if top.kind == "block" and top.typed and not top.call and not top.assign else "value" if top.kind == "value" else "block"
        if top.assign or top.last == "=":
            return "value"
        if top.typed and not top.call:
            return typed
        if top.call:
            # a member's initialiser, or the body
            return "value" if top.colon and (WORD.match(top.last) or top.last == ">") and top.last not in ("try", "const", "noexcept", "override", "final") else "function"
        if top.old and not top.n:
            return "function"
        if top.last == "0" and top.before == "extern":
            return "scope"
        return "block"

    def java(self) -> str:
        top = self.top
        if top.kind == "annotation(":
            return "annotation("
        if top.last == "->":
            return "block"
        if top.last == "[]" and not top.call:
            return "value"
        if top.fresh and top.last == "()":
            return "scope"
        if top.typed and not (top.call and top.typed != "record"):
            return {"enum": "enum", "annotation": "annotation"}.get(top.typed, "scope")
        if top.kind == "enum":
            return "scope"
        if top.kind not in ("scope", "annotation"):
            return "value" if top.kind == "value" else "block"
        if top.assign or top.default:
            return "value"
        return "function" if top.call else "block"

    def closed(self) -> None:
        level = self.top
        while level and level.kind in ("(", "[", "<"):
            level = level.outer
        if level is None or level.outer is None:
            return  # nothing that it could close
        self.top = level.outer.copy()
        if level.kind == "value" or self.top.kind in ("(", "[", "annotation("):
            self.item("{}")
        else:
            self.top.clear()

    def ended(self) -> None:
        while self.top.kind == "<":
            self.pop()
        top = self.top
        top.annotation = 0
        if top.kind in ("(", "["):
            top.plain = False
            self.item(";")
            return
        if top.kind == "enum":
            top.kind = "scope"
        elif top.kind == "scope" and self.kind == "java":
            self.count += top.call and top.named and not top.assign and not top.control and not top.typed
        elif top.kind == "scope":
            self.count += top.call and top.before == "=" and top.last in ("default", "delete")
            # declarations between the parameters and the body, in the old style
            top.old = top.call and top.plain and top.last != "()" and not top.colon and WORD.match(top.last) is not None or top.old and top.n > 1 and not top.call and not top.assign and not top.typed
        top.clear()


def count_functions(code: str | None, language: str | None) -> int:
    """Function definitions of C and C++, methods and constructors of Java; -1 for other languages, 0 for blank code."""
    if not code or not code.strip():
        return 0
    kind = family(language)
    if not kind:
        return -1
    if "(" not in code or kind == "c" and "{" not in code and "=" not in code:
        return 0
    return Parser(kind).read(with_alternatives(code, kind))


def with_alternatives(code: str, kind: str) -> str:
    """Code without comments, literals and preprocessor lines; those of alternatives become marks."""
    text = bare(code, kind)
    return _LINE.sub(lambda m: f" {_MARK.get(m[1], '')} ", text) if kind == "c" else text
