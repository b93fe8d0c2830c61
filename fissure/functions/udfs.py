"""Arrow-batched UDFs over the Python kernel, for what built-in functions can't express."""

from __future__ import annotations

import html
import json
from collections.abc import Callable
from functools import lru_cache, wraps

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from fissure.functions import diffs, lexer, replies, scopes, signatures


def vectorized(returns: str, once: bool = False) -> Callable:
    """A pandas UDF that is made when it is first used, since Spark needs a session to read its type.

    ``once``: a filter on the result stays above it. Otherwise Spark may move the filter below a join, and evaluate the function there and again above.
    """

    def wrap(f: Callable) -> Callable[..., Column]:
        made = lru_cache(1)(lambda: F.pandas_udf(f, returns).asNondeterministic() if once else F.pandas_udf(f, returns))

        @wraps(f)
        def call(*columns: Column | str) -> Column:
            return made()(*columns)

        return call

    return wrap


@vectorized("string")
def signature(code: pd.Series, language: pd.Series) -> pd.Series:
    return pd.Series([signatures.signature(c, x) for c, x in zip(code, language, strict=True)], dtype=object)


@vectorized("code string, functions int", once=True)
def stripped(code: pd.Series, language: pd.Series) -> pd.DataFrame:
    """Code without comments, and the number of its functions, in one pass."""
    out = [lexer.remove_comments(c, x) for c, x in zip(code, language, strict=True)]
    return pd.DataFrame({"code": out, "functions": [scopes.count_functions(c, x) for c, x in zip(out, language, strict=True)]})


@vectorized("int")
def function_count(code: pd.Series, language: pd.Series) -> pd.Series:
    return pd.Series([scopes.count_functions(c, x) for c, x in zip(code, language, strict=True)])


@vectorized("string")
def clean_message(message: pd.Series) -> pd.Series:
    return pd.Series([replies.clean_message(m) for m in message], dtype=object)


@vectorized("string")
def description(raw: pd.Series) -> pd.Series:
    return pd.Series([replies.description(m) for m in raw], dtype=object)


@vectorized("string")
def parse_reply(reply: pd.Series) -> pd.Series:
    return pd.Series([replies.parse_reply(m) for m in reply], dtype=object)


@vectorized("string")
def unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


@vectorized("array<string>")
def sql_values(line: pd.Series) -> pd.Series:
    return line.map(replies.sql_values)


@vectorized("benign array<array<string>>, vulnerable array<array<string>>")
def hunks(before: pd.Series, after: pd.Series) -> pd.DataFrame:
    rows = [diffs.hunks(b, a) for b, a in zip(before, after, strict=True)]
    return pd.DataFrame({"benign": [r[0] for r in rows], "vulnerable": [r[1] for r in rows]})


@vectorized("added array<int>, removed array<int>, regions array<array<int>>")
def changed_lines(before: pd.Series, after: pd.Series) -> pd.DataFrame:
    rows = [diffs.changed_lines(b, a) for b, a in zip(before, after, strict=True)]
    return pd.DataFrame({"added": [r[0] for r in rows], "removed": [r[1] for r in rows], "regions": [[list(x) for x in r[2]] for r in rows]})


@vectorized("unified string, compact string")
def diff_texts(before: pd.Series, after: pd.Series) -> pd.DataFrame:
    pairs = list(zip(before, after, strict=True))
    return pd.DataFrame({"unified": [diffs.unified(b, a) for b, a in pairs], "compact": [diffs.compact(b, a) for b, a in pairs]})


@vectorized("vulnerable_code string, benign_code string, optimized boolean, reduction_ratio double, changed_line_count int, original_size long, optimized_size long, note string")
def optimized(vulnerable: pd.Series, benign: pd.Series) -> pd.DataFrame:
    names = ["vulnerable_code", "benign_code", "optimized", "reduction_ratio", "changed_line_count", "original_size", "optimized_size", "note"]
    return pd.DataFrame([diffs.optimized(v, b) for v, b in zip(vulnerable, benign, strict=True)], columns=names)


@vectorized("string")
def optimized_line(line: pd.Series) -> pd.Series:
    """Lines of JSON, each an entry, with its code cut to the changes; null for what is no JSON object."""
    return pd.Series([diffs.optimized_line(x) for x in line], dtype=object)


@vectorized("array<array<string>>")
def patch_lines(patch: pd.Series, function: pd.Series) -> pd.Series:
    return pd.Series([diffs.lines_from_patch(p, f) for p, f in zip(patch, function, strict=True)], dtype=object)


@vectorized("valid boolean, issues array<string>, confidence double, regenerate boolean")
def review_check(review: pd.Series, cwe: pd.Series) -> pd.DataFrame:
    """Validity, issues as ``section: issue``, confidence and whether to ask again; a text that isn't a JSON object counts as ``{}``."""
    rows = []
    for text, c in zip(review, cwe, strict=True):
        try:
            data = json.loads(text or "{}")
        except ValueError:
            data = {}
        data = data if isinstance(data, dict) else {}
        found = [f"{s}: {x}" for s, xs in replies.issues(data).items() for x in xs]
        score = replies.confidence(data, c)
        rows.append((not found, found, score, score < replies.REGENERATE_BELOW))
    return pd.DataFrame(rows, columns=["valid", "issues", "confidence", "regenerate"])
