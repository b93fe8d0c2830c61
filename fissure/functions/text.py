"""Text rules that must agree with Python string methods, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of ``str.strip`` without the line feed, inside a Java character class: listed, since that is much faster than the Unicode flag.
INNER = r"\t\x0b\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = rf"\n{INNER}"
INLINE = rf"[{INNER}]"
#: Its characters one by one.
CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c != "\n")
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def text(c: Column) -> Column:
    """Null counts as the empty string, as in a CSV file."""
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """``str.strip``; texts whose ends hold no white space are passed on unread."""
    ends = F.concat(F.substring(c, 1, 1), F.right(c, F.lit(1)))
    return F.when(ends.rlike(rf"[{BLANK}]"), F.regexp_replace(c, rf"\A[{BLANK}]++|[{BLANK}]++\z", "")).otherwise(c)


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.regexp_replace(strip(c), rf"[{BLANK}]++", " ")


def split_lines(c: Column) -> Column:
    """``str.splitlines``: no empty line after a final line end."""
    parts = F.split(c, LINE_END)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts))


def unix_lines(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("\r")), F.regexp_replace(c, r"\r\n?", "\n")).otherwise(c)


def canonical(c: Column) -> Column:
    """One line that stays the same under changes of line ends and trailing blanks: the input of the content hash."""
    lines = F.transform(F.split(unix_lines(c), "\n"), lambda line: F.rtrim(line, F.lit(CHARACTERS)))
    out = strip(F.array_join(lines, "\n"))
    for raw, shown in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n")):
        out = F.replace(out, F.lit(raw), F.lit(shown))
    return out


def content_hash(c: Column) -> Column:
    whole = canonical(text(c))
    return F.when(whole == "", "").otherwise(F.sha2(whole, 256))


def drop_blank_runs(c: Column) -> Column:
    """Leading and trailing blank lines go, inner runs of them become one empty line.

    The groups are possessive, since Java's others use stack for each repetition.
    """
    out = F.regexp_replace(c, rf"\A(?:{INLINE}*+\n)++", "")
    out = F.regexp_replace(out, rf"\n(?:{INLINE}*+\n)++", "\n\n")
    out = F.regexp_replace(out, rf"(?:\n{INLINE}*+)++\z", "")
    return F.when(c.rlike(rf"\A[{BLANK}]*+\z"), "").otherwise(out)


def capitalized(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1_000_000)))
