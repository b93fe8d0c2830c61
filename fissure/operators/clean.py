"""Cleaning: a chain of steps on columns, and the funnel of what each step removes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fissure.functions import cwe, languages
from fissure.functions.text import strip, text


@dataclass(frozen=True)
class Step:
    """``keep`` decides on the row as the steps before left it; ``change`` then sets columns."""

    name: str
    keep: Callable[[], Column]
    change: dict[str, Callable[[], Column]] = field(default_factory=dict)


def language_step(allowed=languages.ALLOWED, table: dict[str, str] | None = None) -> Step:
    folded = lambda: languages.fold(F.col("language"), table)
    return Step("language_filter", lambda: folded().isin(*allowed), {"language": folded})


def cwe_step(reject_unknown: bool = True, reject_invalid: bool = True) -> Step:
    """One unknown id rejects the row; a list without ids is kept only if ``reject_invalid`` is off."""
    ids = lambda: cwe.tokens(F.col("cwe"))
    known = lambda: ~F.exists(ids(), cwe.is_unknown) if reject_unknown else F.lit(True)
    packed = lambda: F.array_join(cwe.clean_list(F.col("cwe")), "|")
    return Step("cwe_filter", lambda: F.when(F.size(ids()) == 0, F.lit(not reject_invalid)).otherwise(known()), {"cwe": packed})


def code_step(skip_empty: bool = True, skip_identical: bool = True, min_length: int = 10) -> Step:
    def keep() -> Column:
        before, after = strip(text(F.col("code_before"))), strip(text(F.col("code_after")))
        ok = (F.length(before) >= min_length) & (F.length(after) >= min_length)
        ok = ok & (before != "") & (after != "") if skip_empty else ok
        return ok & (before != after) if skip_identical else ok

    return Step("code_filter", keep)


def url_step() -> Step:
    """A place in the chain; addresses are checked in the transform step."""
    return Step("url_filter", lambda: F.lit(True))


def dedup_step() -> Step:
    """A place in the chain; see ``dedup`` for the operator."""
    return Step("deduplicator", lambda: F.lit(True))


STEPS = (language_step(), cwe_step(), code_step(), url_step(), dedup_step())


def marked(df: DataFrame, steps=STEPS) -> DataFrame:
    """``df`` with the number of steps that each row passes, ``passed``, and its columns as those steps left them."""
    df = df.withColumn("passed", F.lit(0))
    for i, step in enumerate(steps):
        df = df.withColumn("passed", F.when((F.col("passed") == i) & F.coalesce(step.keep(), F.lit(False)), i + 1).otherwise(F.col("passed")))
        for name, change in step.change.items():
            df = df.withColumn(name, F.when(F.col("passed") == i + 1, change()).otherwise(F.col(name)))
    return df


def clean(df: DataFrame, steps=STEPS) -> DataFrame:
    for step in steps:
        df = df.filter(step.keep())
        for name, change in step.change.items():
            df = df.withColumn(name, change())
    return df


def funnel(df: DataFrame, steps=STEPS) -> DataFrame:
    """(source, step, name, input, output, filtered, pct): all steps of all sources in one pass; the share of nothing is 0."""
    counts = marked(df, steps).groupBy("source").agg(*[F.count_if(F.col("passed") >= i).alias(f"n{i}") for i in range(len(steps) + 1)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(s.name).alias("name"), F.col(f"n{i}").alias("input"), F.col(f"n{i + 1}").alias("output")) for i, s in enumerate(steps)])
    out = counts.select("source", F.inline(rows))
    return out.select("*", (F.col("input") - F.col("output")).alias("filtered"), F.when(F.col("input") > 0, 100.0 * (F.col("input") - F.col("output")) / F.col("input")).otherwise(0.0).alias("pct"))
