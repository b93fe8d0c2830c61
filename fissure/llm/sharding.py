"""Sharding by minimax contiguous partition, with DataFrame functions only.

Equal texts form one atomic group. Groups are ordered by the SHA-256 of their text and cut into contiguous shards so that the largest shard is as small as
it can be: the least feasible capacity is found by binary search with a greedy check. A group that by itself outweighs an equal share of what is left gets a
shard of its own first, so that it doesn't spoil the other shards.

The driver sees the order at a bounded resolution: sums of up to 65,536 digest prefixes. The greedy check treats a prefix of several groups as divisible, which bounds the
capacity from below; prefixes that its cuts fall into are looked up at a finer resolution until every cut lies between two groups. Then the bound is reached, so it is
the least capacity.

A null text has no bytes, size 1, no checksum, and forms a group with other null texts. Slots are counted in groups by a hash of doc_id and text, so that missing or repeated doc_ids don't gather. Repeated rows are rows like others; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fissure.llm._common import cut, pick

#: Hexadecimal digits of the first and of each finer resolution; prefixes around each cut that are refined at a time.
FIRST, MORE, AROUND = 4, 2, 4
#: Groups of rows within which slots are counted.
SLOT_BUCKETS = 1024
NULL = "z"


def greedy(edges: list[int], atomic: list[bool], capacity: int, shards: int) -> list[int] | None:
    """Values at which ``shards`` shards of ``capacity`` end, or None if they don't hold all.

    ``edges``: running sums of the blocks from 0. A cut inside a block that isn't atomic stays there; inside an atomic one it moves to the block's start.
    """
    at, cuts = 0, []
    for _ in range(shards):
        if edges[-1] - at <= capacity:
            return cuts
        to = at + capacity
        block = bisect_right(edges, to) - 1
        if atomic[block]:
            to = edges[block]
        if to <= at:
            return None
        cuts.append(to)
        at = to
    return cuts if at >= edges[-1] else None


def least_capacity(edges: list[int], atomic: list[bool], shards: int) -> tuple[int, list[int]]:
    low, high = -(-edges[-1] // shards), edges[-1]
    while low < high:
        middle = (low + high) // 2
        if greedy(edges, atomic, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low, greedy(edges, atomic, low, shards) or []


def cut_keys(groups: DataFrame, shards: int) -> list[str]:
    """Prefixes before which a shard ends, for ``groups(sha, size)``."""

    def blocks(df: DataFrame, digits: int) -> list[tuple[str, int, int]]:
        return [tuple(r) for r in df.groupBy(F.substring("sha", 1, digits).alias("p")).agg(F.sum("size"), F.count("*")).collect()]

    known = sorted(blocks(groups, FIRST))
    while known:
        edges = [0, *accumulate(x[1] for x in known)]
        atomic = [x[2] == 1 for x in known]
        _, cuts = least_capacity(edges, atomic, shards)
        inside = [b for v in cuts if edges[b := bisect_right(edges, v) - 1] != v]
        if not inside:
            return [known[bisect_right(edges, v) - 1][0] for v in cuts]
        near = {i for b in inside for i in range(max(0, b - AROUND), min(len(known), b + AROUND + 1)) if not atomic[i]}
        finer: list[tuple[str, int, int]] = []
        for digits in sorted({len(known[i][0]) for i in near}):
            wanted = [known[i][0] for i in near if len(known[i][0]) == digits]
            finer += blocks(groups.filter(F.substring("sha", 1, digits).isin(wanted)), digits + MORE)
        known = sorted([x for i, x in enumerate(known) if i not in near] + finer)
    return []


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``(doc_id, size, text_crc32, sha, shard, slot)`` for every row of ``docs(doc_id, text)``."""
    rows = pick(docs, "doc_id", "text").select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32("text").alias("text_crc32"), F.coalesce(F.sha2("text", 256), F.lit(NULL)).alias("sha"))
    rows = cut(rows)
    groups = cut(rows.groupBy("sha").agg(F.sum("size").alias("size")))
    left, total, alone = shards, groups.agg(F.sum("size")).first()[0] or 0, []
    for sha, size in groups.orderBy(F.desc("size"), "sha").limit(shards - 1).collect():
        if size * left < total or left == 1:
            break
        alone.append(sha)
        left, total = left - 1, total - size
    keys = cut_keys(groups.filter(~F.col("sha").isin(alone)) if alone else groups, left)
    number = F.lit(len(alone))
    for key in keys:
        number = number + (F.col("sha") >= key).cast("int")
    for i, sha in enumerate(alone):
        number = F.when(F.col("sha") == sha, i).otherwise(number)
    placed = rows.withColumn("shard", number.cast("int")).withColumn("bucket", F.expr(f"pmod(xxhash64(doc_id, sha), {SLOT_BUCKETS})"))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    turn = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "sha"))
    return placed.withColumn("turn", turn).join(offsets, ["shard", "bucket"]).select("doc_id", "size", "text_crc32", "sha", "shard", (F.col("before") + F.col("turn") - 1).cast("long").alias("slot"))
