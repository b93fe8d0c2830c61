"""Names of programming languages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fissure.functions.text import capitalized, strip, text

#: Spellings that the cleaning step folds, file suffixes, aliases before signature extraction, names in benchmark keys.
FOLDED = {"c": "c/c++", "C": "c/c++", "cpp": "c/c++", "c++": "c/c++", "C++": "c/c++", "Cpp": "c/c++", "CPP": "c/c++", "C/C++": "c/c++", "java": "java", "Java": "java", "JAVA": "java"}
SUFFIXES = {
    "c": "c", "h": "c", "cc": "cpp", "cpp": "cpp", "cxx": "cpp", "hpp": "cpp", "hxx": "cpp", "java": "java", "py": "python", "cs": "csharp", "js": "javascript", "ts": "typescript",
    "rb": "ruby", "php": "php", "jsp": "jsp", "go": "go", "rs": "rust", "swift": "swift", "kt": "kotlin", "m": "objective-c", "mm": "objective-cpp", "scala": "scala", "vb": "vb", "pl": "perl", "lua": "lua", "sh": "shell",
}
ALIASES = {"c++": "cpp", "c#": "csharp", "objective-c++": "objective-cpp", "objc": "objective-c", "objc++": "objective-cpp", "typescriptreact": "typescript", "javascriptreact": "javascript"}
SHOWN = {"c": "C/C++", "c++": "C/C++", "cpp": "C/C++", "java": "Java", "python": "Python", "py": "Python", "javascript": "JavaScript", "js": "JavaScript", "php": "PHP"}
ALLOWED = ("c/c++", "java")


def lookup(c: Column, table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[c]


def fold(c: Column, table: dict[str, str] | None = None) -> Column:
    """The folded name, or the stripped text where it isn't known."""
    return F.coalesce(lookup(strip(text(c)), table or FOLDED), strip(text(c)))


def fold_or_null(c: Column) -> Column:
    return lookup(strip(text(c)), FOLDED)


def shown(c: Column) -> Column:
    low = F.lower(strip(text(c)))
    return F.when(text(c) == "", "Unknown").otherwise(F.coalesce(lookup(low, SHOWN), capitalized(low)))


def from_filename(c: Column) -> Column:
    """By the last suffix of the last path part; a name that only begins with a dot has none."""
    name = F.regexp_extract(text(c), r"([^/]*)/*$", 1)
    suffix = F.lower(F.regexp_extract(name, r"^.*[^.].*?\.([^.]+)$|^[^.]+\.([^.]+)$", 1))
    return F.when(text(c).isin("", "None", "null"), "").otherwise(F.coalesce(lookup(suffix, SUFFIXES), suffix))


def alias(c: Column) -> Column:
    low = F.lower(strip(text(c)))
    return F.coalesce(lookup(low, ALIASES), low)
