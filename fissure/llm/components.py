"""Connected components of a graph given as links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fissure.llm._common import cut, merged


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node to the smallest of them and itself; ``links`` has ``a > b``."""
    around = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        around = around.unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = around.join(merged(least), "u")
    out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if large else joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``, two columns of longs; ``root`` is the component's smallest node.

    Each round halves the distance to the root at least, and is written to the checkpoint folder. Nodes without links do not appear.
    """
    now = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    state = _state(now)
    while state[0]:
        now = cut(_star(_star(now, True), False))
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
