"""The weakness taxonomy: flattening, lookups and coverage."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fissure.functions import cwe as ids

NODES = "ord int, category string, category_id string, cwd string, name string, parent_cwd string, level int"
PAIRS = "cwe string, cwd string, ord int"


def _walk(items: list, category: str, category_id: str | None, parent: str | None, level: int) -> Iterator[tuple]:
    for item in items or []:
        yield category, category_id, item.get("id"), item.get("name"), parent, level, item.get("cwe") or []
        yield from _walk(item.get("children"), category, category_id, item.get("id"), 3)


def flatten(spark: SparkSession, tree: dict) -> tuple[DataFrame, DataFrame]:
    """Nodes and (cwe, cwd) pairs in document order; roots of a category have level 2, all below them level 3."""
    nodes, pairs = [], []
    for category, body in tree.items():
        body = body if isinstance(body, dict) else {}
        for *node, cwes in _walk(body.get("items"), category, body.get("id"), None, 2):
            nodes.append((len(nodes), *node))
            pairs += [(str(c), node[2], len(pairs) + i) for i, c in enumerate(cwes)]
    return spark.createDataFrame(nodes, NODES), spark.createDataFrame(pairs, PAIRS)


def target_ids(tree: object) -> set[str]:
    """All weakness ids in any leaf of a taxonomy document."""
    if isinstance(tree, dict):
        return set().union(*map(target_ids, tree.values())) if tree else set()
    if isinstance(tree, list):
        return set().union(*map(target_ids, tree)) if tree else set()
    import re

    text = str(tree).upper().strip()
    found = {f"CWE-{int(d)}" for d in re.findall(r"CWE-(\d+)", text)}
    return found or ({f"CWE-{int(text)}"} if text.isdigit() else set())


def mapping(pairs: DataFrame) -> DataFrame:
    """(cwe, cwds): the classes of each id in document order, repeats included."""
    listed = pairs.groupBy("cwe").agg(F.array_sort(F.collect_list(F.struct("ord", "cwd"))).alias("s"))
    return listed.select("cwe", F.transform("s", lambda x: x["cwd"]).alias("cwds"))


#: Ids up to which the classes of further ids are looked up in one map that every task holds.
FEW = 20_000


def with_cwds(rows: DataFrame, pairs: DataFrame, cwes: str = "cwes") -> DataFrame:
    """``rows`` with primary_cwe, other_cwes, cwd and other_cwds of the id list ``cwes``.

    The primary id is looked up by a join. The others are looked up in a map of the whole mapping if that has up to FEW ids, which is counted first; beyond, by joins of the distinct lists of other ids.
    """
    first = mapping(pairs).select(F.col("cwe").alias("primary_cwe"), F.get("cwds", F.lit(0)).alias("first_cwd"))
    primary = ids.primary(F.col(cwes))
    names = rows.columns
    rows = rows.withColumn("primary_cwe", primary).withColumn("other_cwes", ids.others(F.col(cwes)))
    if first.limit(FEW + 1).count() <= FEW:
        known: Column = F.col("known_cwds")
        rows = rows.join(F.broadcast(first.agg(F.map_from_entries(F.collect_list(F.struct("primary_cwe", "first_cwd"))).alias("known_cwds"))))
        rows = rows.withColumn("cwd", known[F.col("primary_cwe")]).withColumn("mapped_cwds", F.transform("other_cwes", lambda c: known[c]))
    else:
        lists = rows.select("other_cwes").distinct().select("other_cwes", F.posexplode("other_cwes").alias("i", "primary_cwe")).join(first, "primary_cwe")
        lists = lists.groupBy("other_cwes").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "first_cwd"))), lambda x: x["first_cwd"]).alias("mapped_cwds"))
        rows = rows.join(first.withColumnRenamed("first_cwd", "cwd"), "primary_cwe", "left").join(lists, "other_cwes", "left")
    cwd = F.when(~ids.is_unknown(F.col("primary_cwe")), F.col("cwd"))
    others = F.array_distinct(F.filter(F.coalesce("mapped_cwds", F.array().cast("array<string>")), lambda x: x.isNotNull() & ~x.eqNullSafe(F.col("cwd"))))
    return rows.withColumn("cwd", cwd).withColumn("other_cwds", others).select(*names, "primary_cwe", "other_cwes", "cwd", "other_cwds")


def all_cwds(rows: DataFrame, pairs: DataFrame, cwe: str = "cwe") -> DataFrame:
    """``rows`` with the list of all classes of an id; empty if there is none."""
    return rows.join(mapping(pairs), cwe, "left").withColumn("cwds", F.coalesce("cwds", F.array().cast("array<string>")))


def class_counts(rows: DataFrame) -> DataFrame:
    """(cwd, language, n) by class and language, and by class alone (language null)."""
    return rows.groupingSets([["cwd"], ["cwd", "language"]], "cwd", "language").agg(F.count("*").alias("n"))


def progress(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Every class of the taxonomy with its number of rows, 0 included."""
    counts = rows.groupBy("cwd").agg(F.count("*").alias("n"))
    return nodes.join(counts, "cwd", "left").select("category", "cwd", "name", F.coalesce("n", F.lit(0)).alias("n"))


def progress_summary(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    return progress(nodes, rows).agg(F.count("*").alias("total"), F.count_if(F.col("n") > 0).alias("covered"), F.sum("n").alias("samples"))


def coverage(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(category, level, total, covered) by category and level, by either, and over all."""
    found = progress(nodes, rows).select("cwd", "n").join(nodes.select("cwd", "category", "level"), "cwd")
    sets = [["category", "level"], ["category"], ["level"], []]
    return found.groupingSets([[F.col(c) for c in s] for s in sets], "category", "level").agg(F.count("*").alias("total"), F.count_if(F.col("n") > 0).alias("covered"))


def outside(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Classes of rows that the taxonomy doesn't have."""
    return rows.select("cwd").filter("cwd is not null").distinct().join(nodes.select("cwd"), "cwd", "left_anti")


def dense_counts(rows: DataFrame, targets: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, cwe, n) for every source and target id, zeros included: the result has a row for every pair of the two, so both lists are to be short."""
    counts = rows.join(targets, "cwe", "left_semi").groupBy("source", "cwe").agg(F.count("*").alias("n"))
    listed = targets.agg(F.collect_set("cwe").alias("listed"))
    grid = sources.select("source").distinct().crossJoin(listed).select("source", F.explode("listed").alias("cwe"))
    return grid.join(counts, ["source", "cwe"], "left").select("source", "cwe", F.coalesce("n", F.lit(0)).alias("n"))


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)
