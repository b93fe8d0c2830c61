"""Counts and reports over canonical rows and benchmark entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fissure.functions import cwe
from fissure.functions.text import text
from fissure.operators.sampling import size_class


def grouped(rows: DataFrame, key: str = "cwe") -> DataFrame:
    """Rows by id; a missing id is ``Unknown``."""
    return rows.groupBy(F.coalesce(F.col(key), F.lit("Unknown")).alias(key)).agg(F.count("*").alias("n"))


def counts(rows: DataFrame, key: str = "cwe", exclude_unknown: bool = False) -> DataFrame:
    rows = rows.filter(~cwe.is_unknown(F.col(key))) if exclude_unknown else rows
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def statistics(rows: DataFrame, key: str = "cwe", row: str = "row_id") -> DataFrame:
    """total, distinct ids, rows whose id is unknown or empty, the others, and the ten most frequent ids with their numbers (of equal ones the one seen first): one row."""
    each = rows.groupBy(F.coalesce(F.col(key), F.lit("")).alias("id")).agg(F.count("*").alias("n"), F.min(row).alias("first_row"))
    missing = F.when(F.col("id").isin("Unknown", ""), F.col("n")).otherwise(0)
    totals = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct_ids"), F.coalesce(F.sum(missing), F.lit(0)).alias("unknown"))
    top = each.orderBy(F.desc("n"), "first_row", "id").limit(10).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "first_row", "id"))).alias("top"))
    most = F.transform("top", lambda x: F.struct(x["id"].alias("id"), (-x["less"]).alias("n")))
    return totals.crossJoin(top).select("total", "distinct_ids", "unknown", (F.col("total") - F.col("unknown")).alias("valid"), most.alias("most_common"))


def most_common(rows: DataFrame, n: int = 10, key: str = "cwe", row: str = "row_id") -> DataFrame:
    """The ``n`` most frequent ids; of equal ones the one seen first."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(row).alias("first_row")).orderBy(F.desc("n"), "first_row").limit(n).select(key, "n")


def shares(rows: DataFrame, by: list[str]) -> DataFrame:
    """Count and percentage of all rows per group."""
    return rows.groupBy(*by).agg(F.count("*").alias("n")).withColumn("pct", F.bround(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def single_and_multi(rows: DataFrame, key: str, others: str) -> DataFrame:
    """Rows per id with and without further ids, and the share without."""
    many = F.coalesce(F.size(others), F.lit(0)) > 0
    out = rows.groupBy(key).agg(F.count("*").alias("total"), F.count_if(~many).alias("single"), F.count_if(many).alias("multi"))
    return out.withColumn("single_ratio", 100.0 * F.col("single") / F.col("total"))


def ratio_histogram(ratios: DataFrame) -> DataFrame:
    """Ids per fifth of the single ratio; a ratio of 100 has a bin of its own."""
    low = F.when(F.col("single_ratio") >= 100, 100).otherwise(F.floor(F.col("single_ratio") / 20) * 20).cast("int")
    return ratios.groupBy(low.alias("low")).agg(F.count("*").alias("n"))


def by_language_and_id(rows: DataFrame, key: str = "cwe") -> DataFrame:
    return rows.rollup("language", key).agg(F.count("*").alias("n"))


def summary(rows: DataFrame, key: str = "cwe") -> DataFrame:
    """Totals by language, by id over all languages, and over all."""
    return rows.groupingSets([[F.col("language")], [F.col(key)], []], "language", key).agg(F.count("*").alias("n"))


def top_per_language(rows: DataFrame, n: int = 10, key: str = "cwd") -> DataFrame:
    counted = rows.groupBy("language", key).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), key))
    return counted.withColumn("rank", rank).filter(F.col("rank") <= n)


def retention(before: DataFrame, after: DataFrame, by: tuple[str, str] = ("language", "cwe")) -> DataFrame:
    """Rows before and after a filter, by both columns, by the first, and over all. Counts are added up before they are joined."""
    marked = before.select(*by, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select(*by, F.lit(0).alias("b"), F.lit(1).alias("a")))
    out = marked.rollup(*by).agg(F.sum("b").alias("original"), F.sum("a").alias("kept"))
    return out.withColumn("pct", F.when(F.col("original") > 0, 100.0 * F.col("kept") / F.col("original")).otherwise(0.0))


def size_classes(rows: DataFrame, by: list[str], large: int = 5000, medium: int = 100) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n")).withColumn("size_class", size_class(F.col("n"), large, medium))


def function_stats(rows: DataFrame, count: Column) -> DataFrame:
    n = rows.select(count.alias("k"))
    return n.agg(F.count("*").alias("total"), F.count_if(F.col("k") == 1).alias("single_function"), F.count_if(F.col("k") > 1).alias("multiple_functions"), F.count_if(F.col("k") == 0).alias("no_functions"), F.count_if(F.col("k") == -1).alias("parse_failures"))


def optimization_stats(rows: DataFrame) -> DataFrame:
    """Of rows with ``opt``, the result of the excerpt UDF."""
    done = F.col("opt.optimized")
    sums = rows.agg(F.count("*").alias("total_entries"), F.count_if(done).alias("optimized_entries"), F.coalesce(F.sum(F.when(done, F.col("opt.original_size"))), F.lit(0)).alias("total_original_size"), F.coalesce(F.sum(F.when(done, F.col("opt.optimized_size"))), F.lit(0)).alias("total_optimized_size"))
    saved = F.col("total_original_size") - F.col("total_optimized_size")
    return sums.select(
        "*",
        F.when(F.col("total_entries") > 0, F.col("optimized_entries") / F.col("total_entries")).otherwise(0.0).alias("optimization_rate"),
        F.when(F.col("total_original_size") > 0, saved / F.col("total_original_size")).otherwise(0.0).alias("overall_reduction_ratio"),
        (saved / 4).cast("bigint").alias("estimated_token_savings"),
    )


def message_stats(rows: DataFrame, before: str, after: str) -> DataFrame:
    """Messages that cleaning changed, that were clean already, and that are missing."""
    has = text(F.col(before)) != ""
    same = F.col(before).eqNullSafe(F.col(after))
    return rows.agg(F.count("*").alias("total"), F.count_if(has & ~same).alias("cleaned"), F.count_if(has & same).alias("already_clean"), F.count_if(~has).alias("no_message"))
