"""Commit and repository addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fissure.functions.text import strip, text


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text(c), pattern, group), F.lit(""))


def ensure_https(c: Column) -> Column:
    whole = strip(text(c))
    return F.when((whole == "") | whole.rlike("^https?://"), whole).otherwise(F.concat(F.lit("https://"), F.regexp_replace(whole, "^/+", "")))


def commit_url(repo: Column, commit: Column) -> Column:
    return F.when((text(repo) == "") | (text(commit) == ""), "").otherwise(F.concat(F.regexp_replace(repo, "/+$", ""), F.lit("/commit/"), commit))


def commit_hash(c: Column) -> Column:
    return _found(c, "/commit/([0-9a-f]+)")


def repo_key(c: Column) -> Column:
    """``owner/name`` of an address on the code host, else null."""
    pattern = "github\\.com/([^/]+)/([^/]+)"
    return F.concat(_found(c, pattern, 1), F.lit("/"), _found(c, pattern, 2))


def commit_parts(c: Column) -> Column:
    """owner, repo and commit of an address that is nothing else; else a null struct."""
    pattern = "^https://github\\.com/([^/]+)/([^/]+)/commit/([a-f0-9]+)"
    return F.when(_found(c, pattern, 3).isNotNull(), F.struct(*(_found(c, pattern, i).alias(n) for i, n in enumerate(("owner", "repo", "commit"), 1))))
