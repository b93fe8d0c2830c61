"""Comments and literals of C, C++ and Java code, by a hand-written scanner.

On broken code it is a guess: an unterminated comment runs to the end, an unterminated literal to the end of its line.
"""

from __future__ import annotations

import re

C_NAMES = {"c", "c/c++", "c++", "cpp"}
CONTROL = {"if", "for", "while", "switch", "catch", "return", "sizeof", "do", "else", "try", "synchronized", "new", "throw", "assert", "case", "delete", "alignof", "decltype", "defined"}
TOKEN = re.compile(r"[^\W\d]\w*|->|::|==|!=|<=|>=|&&|\|\||[{}()\[\];,:=<>~@?]|\S")
_START = re.compile(r'//|/\*|"""|R"|"|\'')


def family(language: str | None) -> str | None:
    name = (language or "").strip().lower()
    return "c" if name in C_NAMES else "java" if name == "java" else None


def pieces(code: str, kind: str) -> list[tuple[str, int, int]]:
    """('comment' or 'literal', start, end) in order."""
    out, at = [], 0
    while m := _START.search(code, at):
        i, mark = m.start(), m.group()
        if mark == "//":
            end = i
            while True:
                end = code.find("\n", end)
                if end < 0:
                    end = len(code)
                elif kind == "c" and code[max(0, end - 2) : end].endswith(("\\", "\\\r")):
                    end += 1
                    continue
                break
            out.append(("comment", i, end))
        elif mark == "/*":
            end = code.find("*/", i + 2)
            end = len(code) if end < 0 else end + 2
            out.append(("comment", i, end))
        elif mark == '"""' and kind == "java":
            end = i + 3
            while (end := code.find('"""', end)) > 0 and code[end - 1] == "\\":
                end += 1
            end = len(code) if end < 0 else end + 3
            out.append(("literal", i, end))
        elif mark == 'R"' and kind == "c" and (raw := re.compile(r'R"([^()\\\s]{0,16})\(').match(code, i)) and not re.search(r"[A-Za-z0-9_]$", re.sub(r"(?:u8|u|U|L)$", "", code[max(0, i - 3) : i])):
            close = f"){raw.group(1)}\""
            end = code.find(close, raw.end())
            end = len(code) if end < 0 else end + len(close)
            out.append(("literal", i, end))
        elif mark == "'" and i and re.search(r"(?:^|[^\w'])[0-9][\w']*$", code[max(0, i - 24) : i]):
            end = i + 1  # a digit separator
        else:
            quote = "'" if mark == "'" else '"'
            end = i + len(mark) if mark == 'R"' else i + 1
            while end < len(code) and code[end] != quote and code[end] != "\n":
                end += 2 if code[end] == "\\" else 1
            end = min(len(code), end + 1) if end < len(code) and code[end] == quote else min(len(code), end)
            out.append(("literal", i, end))
        at = end
    return out


def clean_blank(code: str) -> str:
    """Runs of blank lines become one empty line; none at the ends."""
    kept: list[str] = []
    for line in code.split("\n"):
        if line.strip():
            kept.append(line)
        elif kept and kept[-1]:
            kept.append("")
    return "\n".join(kept[:-1] if kept and not kept[-1] else kept)


def remove_comments(code: str | None, language: str | None) -> str | None:
    """Code without comments and with tidy blank lines; unchanged if there is no comment or the language isn't supported."""
    kind = family(language)
    if not code or not code.strip() or not kind:
        return code
    cut = [(a, b) for what, a, b in pieces(code, kind) if what == "comment"]
    if not cut:
        return code
    parts, at = [], 0
    for a, b in cut:
        parts.append(code[at:a])
        at = b
    return clean_blank("".join([*parts, code[at:]]))


def bare(code: str, kind: str) -> str:
    """Code in which comments are blank and literals are ``0``."""
    parts, at = [], 0
    for what, a, b in pieces(code, kind):
        parts += [code[at:a], " 0 " if what == "literal" else " "]
        at = b
    return "".join([*parts, code[at:]])
