"""Samples of groups of rows. All random order is the order of a hash of the row number, so that it is the same in every run. Nulls in groups and strata are a group and a stratum of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled(seed: int = 42, row: str = "row_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(row).cast("string")))


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by ``keys`` in which nulls are equal, as they are in groups; the key columns are those of ``left``."""
    theirs = {k: f"joined key {i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(theirs)
    same = [left[f"`{k}`"].eqNullSafe(right[f"`{other}`"]) for k, other in theirs.items()]
    return left.join(right, same, how).drop(*theirs.values())


def with_sizes(rows: DataFrame, group: list[str], name: str = "group_size") -> DataFrame:
    """``rows`` with the size of their group: an aggregation and a join, not a window over whole groups."""
    counts = rows.groupBy(*group).agg(F.count("*").alias(name))
    return joined(rows, counts, group)


def numbered(rows: DataFrame, group: list[str], by: str | None = None, row: str = "row_id", block: int = 1 << 20) -> DataFrame:
    """``rows`` with ``at``, their number from 0 in the order of ``by`` and ``row`` within their group, and ``of``, the group's size.

    Rows are counted by value and block of row numbers; the counts give each block's first number, so that a window sorts one block of one value at a time, and rows are shuffled once.
    """
    parts = [*group, *([by] if by else []), "block"]
    keyed = rows.withColumn("block", F.expr(f"`{row}` div {block}")).withColumn("block_key", F.struct(*parts))
    counts = keyed.groupBy("block_key").agg(F.count("*").alias("n"))
    inside = Window.partitionBy(*[f"block_key.{g}" for g in group])
    before = F.sum("n").over(inside.orderBy(*[f"block_key.{c}" for c in parts[len(group) :]])) - F.col("n")
    counts = counts.select("block_key", before.alias("before"), F.sum("n").over(inside).alias("of"))
    turn = F.row_number().over(Window.partitionBy("block_key").orderBy(row)) - 1
    return keyed.withColumn("turn", turn).join(counts, "block_key").withColumn("at", F.col("before") + F.col("turn")).drop("block", "block_key", "turn", "before")


def size_class(n: Column, large: int = 5000, medium: int = 100) -> Column:
    return F.when(n >= large, "large").when(n >= medium, "medium").otherwise("small")


def quotas(rows: DataFrame, group: list[str], stratum: str, n: int) -> DataFrame:
    """(group, stratum, available, quota): shares in proportion, at least one each, until ``n`` is used up in order of stratum."""
    counts = rows.groupBy(*group, stratum).agg(F.count("*").alias("available"))
    whole = Window.partitionBy(*group)
    share = F.greatest(F.lit(1), F.floor(F.lit(n) * F.col("available") / F.sum("available").over(whole))).cast("bigint")
    counts = counts.withColumn("share", share)
    used = F.coalesce(F.sum("share").over(whole.orderBy(stratum).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select(*group, stratum, "available", F.least("available", F.least("share", F.greatest(F.lit(0), n - used))).cast("bigint").alias("quota"))


def stratified(rows: DataFrame, group: list[str], stratum: str, n: int, seed: int = 42) -> DataFrame:
    """Up to ``n`` rows of each group, by quota of each stratum."""
    allowed = quotas(rows, group, stratum, n).select(*group, stratum, "quota")
    turn = F.row_number().over(Window.partitionBy(*group, stratum).orderBy(shuffled(seed), "row_id"))
    return joined(rows.withColumn("turn", turn).filter(F.col("turn") <= n), allowed, [*group, stratum]).filter("turn <= quota").drop("turn", "quota")


def capped(rows: DataFrame, group: list[str], stratum: str, most: int = 300, seed: int = 42) -> DataFrame:
    """Groups of more than ``most`` rows are sampled by stratum, others stay whole."""
    sized = with_sizes(rows, group)
    small = sized.filter(F.col("group_size") <= most).drop("group_size")
    large = stratified(sized.filter(F.col("group_size") > most).drop("group_size"), group, stratum, most, seed)
    return small.unionByName(large)


def random(rows: DataFrame, group: list[str], n: int, seed: int = 42) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy(*group).orderBy(shuffled(seed), "row_id"))
    return rows.withColumn("turn", turn).filter(F.col("turn") <= n).drop("turn")


def top(rows: DataFrame, group: list[str], n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of each group in the given order, ties by row number."""
    turn = F.row_number().over(Window.partitionBy(*group).orderBy(*order, "row_id"))
    return rows.withColumn("turn", turn).filter(F.col("turn") <= n).drop("turn")


def diverse(rows: DataFrame, group: list[str], n: int, by: str) -> DataFrame:
    """``n`` rows of each group in even steps of the order by ``by``; groups of up to ``n`` rows stay whole."""
    rows = numbered(rows, group, by)
    step = F.col("of") / F.lit(float(n))
    nearest = F.floor((F.col("at") + 1 - step / 2) / step)
    hit = F.exists(F.array(nearest - 1, nearest, nearest + 1), lambda i: (i >= 0) & (i < n) & (F.floor(i * step + step / 2) == F.col("at")))
    return rows.filter((F.col("of") <= n) | hit).drop("at", "of")


def candidates(rows: DataFrame, group: list[str], k: int, multiplier: int = 4) -> DataFrame:
    """The best ``k * multiplier`` rows of each group by ``score_key``, a struct of (has_benign, has_url, fill_score)."""
    return top(rows, group, k * multiplier, [F.desc("score_key.has_benign"), F.desc("score_key.has_url"), F.desc("score_key.fill_score")])


def select(rows: DataFrame, group: list[str], n: int, strategy: str, seed: int = 42) -> DataFrame:
    """A strategy by name: stratified, balanced, top or random; rows have total_lines and vuln_lines."""
    if strategy == "stratified":
        return diverse(rows, group, n, "total_lines")
    if strategy == "balanced":
        return diverse(rows, group, n, "vuln_lines")
    if strategy == "top":
        return top(rows, group, n, [F.desc("total_lines")])
    if strategy == "random":
        return random(rows, group, n, seed)
    raise ValueError(f"unknown strategy {strategy!r}")


def one_per_source(entries: DataFrame) -> DataFrame:
    """The first entry of each source in the order of the document: language, class, position."""
    order = F.struct("language", "cwd", "pos")
    return entries.groupBy("source").agg(F.min_by(F.struct(*entries.columns), order).alias("row")).select("row.*")


def spot_check(rows: DataFrame, passed: Column, n: int = 60, seed: int = 7) -> DataFrame:
    """``n`` random rows with ``passed``."""
    return rows.orderBy(shuffled(seed), "row_id").limit(n).withColumn("passed", F.coalesce(passed, F.lit(False)))


def tally(checked: DataFrame) -> DataFrame:
    """How many of the rows of ``spot_check`` passed and failed: one row."""
    return checked.agg(F.count("*").alias("checked"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))
