"""Removal of rows that several sources share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fissure.functions import cwe, udfs
from fissure.functions.text import content_hash, strip, text


def manifest(rows: DataFrame) -> DataFrame:
    """One line per row: prototype of the newer code, content hashes, and where the row stands."""
    newer = F.when(text(F.col("code_after")) != "", F.col("code_after")).otherwise(text(F.col("code_before")))
    return rows.select(udfs.signature(newer, "language").alias("signature"), F.col("source").alias("dataset"), F.col("row_id").alias("row"), strip(text(F.col("cwe"))).alias("cwe"), strip(text(F.col("language"))).alias("language"), content_hash(F.col("code_before")).alias("code_before_hash"), content_hash(F.col("code_after")).alias("code_after_hash"), "commit_url")


def rank_key(mode: str) -> list[Column]:
    """Order of preference of representatives; equal up to the row.

    ``compat``: ids packed with bars count as one token and have no number. ``fixed``: they are counted, and the first id's number decides next.
    """
    if mode == "compat":
        count = F.greatest(F.size(F.filter(F.split("cwe", "[;,]"), lambda x: strip(x) != "")), F.when(strip(F.col("cwe")) != "", 1).otherwise(0))
        return [F.when(F.col("cwe") == "", 0).otherwise(count), F.lit(0), F.col("dataset"), F.col("row")]
    return [F.size(cwe.tokens(F.col("cwe"))), F.coalesce(cwe.number(F.col("cwe")), F.lit(2**62)), F.col("dataset"), F.col("row")]


def drops(lines: DataFrame, mode: str = "compat", key: str = "signature") -> DataFrame:
    """(dataset, row) of rows to drop: all but one representative of each key that two or more datasets share.

    Datasets of a key are compared by minimum and maximum, which are aggregated before the shuffle; only keys that do span datasets are looked at row by row, and their
    representative is a minimum too. No group is ever gathered, whatever its size. In ``fixed`` mode the empty key is no group.
    """
    lines = lines.filter(F.col(key) != "") if mode == "fixed" else lines
    order = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(rank_key(mode))])
    keys = lines.groupBy(key).agg(F.min("dataset").alias("low"), F.max("dataset").alias("high"), F.min(order).alias("best")).filter("low <> high").select(key, "best")
    return lines.join(keys, key).filter(~order.eqNullSafe(F.col("best"))).select("dataset", "row")


def without_drops(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    gone = dropped.select(F.col("dataset").alias("source"), F.col("row").alias("row_id"))
    return rows.join(gone, ["source", "row_id"], "left_anti")


def renumbered(rows: DataFrame, group: str = "source", row: str = "row_id", block: int = 1 << 20) -> DataFrame:
    """``rows`` with ``kept_row``: 1, 2, ... in each group by ``row``.

    Counts of blocks of row numbers give each block's offset, so that a window sorts one block of one group at a time.
    """
    rows = rows.withColumn("block", F.expr(f"{row} div {block}"))
    offsets = rows.groupBy(group, "block").agg(F.count("*").alias("n")).select(group, "block", (F.sum("n").over(Window.partitionBy(group).orderBy("block")) - F.col("n")).alias("before"))
    turn = F.row_number().over(Window.partitionBy(group, "block").orderBy(row))
    return rows.withColumn("turn", turn).join(offsets, [group, "block"]).withColumn("kept_row", F.col("before") + F.col("turn")).drop("block", "turn", "before")


def checked_manifest(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Manifest lines of ``rows``; a row without a line raises an error."""
    joined = rows.select(F.col("source").alias("dataset"), F.col("row_id").alias("row")).join(lines, ["dataset", "row"], "left")
    return joined.withColumn("signature", F.when(F.col("code_before_hash").isNull(), F.raise_error(F.concat(F.lit("no manifest line for "), "dataset", F.lit(" "), F.col("row").cast("string"))).cast("string")).otherwise(F.col("signature")))


def totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("dataset").agg(F.count("*").alias("total"), F.count_distinct("signature").alias("distinct_signatures"))


