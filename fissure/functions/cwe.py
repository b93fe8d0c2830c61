"""Weakness ids: normal forms, predicates and lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fissure.functions.text import strip, text


def _plain(digits: Column) -> Column:
    """Digits without leading zeros, whatever their number."""
    return F.regexp_replace(digits, r"^0+(?=\d)", "")


def normalize(c: Column) -> Column:
    """``CWE-<n>`` from any spelling of the prefix; other text as it is; null as empty."""
    whole = strip(text(c))
    digits = F.regexp_extract(whole, r"(?i)cwe[-_\s]*(\d+)", 1)
    return F.when(digits != "", F.concat(F.lit("CWE-"), _plain(digits))).otherwise(whole)


def normalize_strict(c: Column) -> Column:
    """Hyphenated ids and bare numbers alone; else null."""
    whole = F.upper(strip(text(c)))
    digits = F.coalesce(F.nullif(F.regexp_extract(whole, r"CWE-(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(whole, r"^(\d+)$", 1), F.lit("")))
    return F.concat(F.lit("CWE-"), _plain(digits))


def normalize_rollup(c: Column) -> Column:
    """The whole text must be the prefix and a number, or a number; else null."""
    digits = F.regexp_extract(F.upper(strip(text(c))), r"^(?:CWE-)?0*(\d+)$", 1)
    return F.when(digits != "", F.concat(F.lit("CWE-"), _plain(digits)))


def normalize_first(c: Column) -> Column:
    """The first id with its leading zeros; text with the prefix as it is; else null."""
    whole = F.upper(strip(text(c)))
    digits = F.regexp_extract(whole, r"CWE[-_]?(\d+)", 1)
    return F.when(digits != "", F.concat(F.lit("CWE-"), digits)).when(F.startswith(whole, F.lit("CWE")), whole)


def number(c: Column) -> Column:
    whole = strip(text(c))
    return F.coalesce(F.regexp_extract(whole, r"(?i)cwe[-_\s]*(\d+)", 1).try_cast("bigint"), whole.try_cast("bigint"))


def is_valid(c: Column) -> Column:
    return number(c).isNotNull()


def is_unknown(c: Column) -> Column:
    whole = strip(text(c))
    return (whole == "") | (F.lower(whole) == "unknown") | ~is_valid(c)


def all_ids(c: Column) -> Column:
    """Every hyphenated id in a text, distinct, in order; a bare number counts if there is none."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.upper(text(c)), F.lit(r"CWE-(\d+)"), 1), lambda d: F.concat(F.lit("CWE-"), _plain(d))))
    single = normalize_strict(c)
    return F.when(F.size(found) > 0, found).when(single.isNotNull(), F.array(single)).otherwise(F.array().cast("array<string>"))


def tokens(c: Column) -> Column:
    """Parts between bars, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text(c), r"\|"), strip), lambda x: x != "")


def clean_list(c: Column) -> Column:
    """Known ids of a packed list, normalized, in order, repeats included."""
    return F.filter(F.transform(tokens(c), normalize), lambda x: ~is_unknown(x))


def primary(ids: Column) -> Column:
    return F.get(ids, F.lit(0))


def others(ids: Column) -> Column:
    return F.slice(ids, 2, F.greatest(F.size(ids), F.lit(1)))
