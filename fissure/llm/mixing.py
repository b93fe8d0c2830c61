"""Mixing sources to target weights with pivotal dependent rounding.

A source's target over its size is the number of copies each of its documents should have on average. The whole part is certain; the
rest is rounded so that the words taken hardly vary: two documents with fractional parts exchange mass, counted in words, at random and
without bias until one of them is whole. Groups of about ``FAN`` documents of one source are reduced so to a single fractional document each, which
the next level of the tree pairs with those of other groups. The last step of a source also holds a reserve of about ``FAN`` documents,
rounds what is left over and evens the remainder out with documents of the reserve, within 0 and ``limit`` copies. Evening out follows the sizes, not chance: documents of the reserve, about ``FAN`` of a
source, may be taken a little more or less often than their share; all others are rounded without bias.

Null texts have the size 0; a null source is a source of its own, last in order. Random numbers depend on the seed, the source and the group alone, so
reruns agree. Rows are dealt to groups by a hash of their content and their number among equal rows, so that neither a doc_id that many rows share nor missing ones gather in a group. Repeated rows
are documents like others; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fissure.llm._common import cut, pick

FAN = 512
LIMIT = 3
ROW = "doc_id long, source string, size long, content long, turn long, whole long, mass double, up long, node long"
ORDER = ["doc_id", "content", "turn", "mass"]
#: Copies of one row that are written one after another.
RUN = 64


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = LIMIT) -> DataFrame:
    """``(source, source_size, n, target)`` of ``sizes(source, size)``.

    Sources by code point, nulls last, weigh ``weights`` in turn. Targets share the sum of all sizes by weight but end at ``limit`` times the source's size:
    filled from the source with the least limit for its weight, as long as that lies below its share of what is left.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    each = each.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))).withColumn("most", limit * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(Window.partitionBy()) - before) / after
    each = each.withColumn("level", level).withColumn("open", F.col("most") / F.col("weight") >= F.col("level"))
    # the level rises from row to row until the first open one and falls after it
    first = F.max(F.when(F.col("open"), F.col("level"))).over(Window.partitionBy())
    return each.select("source", "source_size", "n", F.least(F.col("most").cast("double"), F.coalesce(first * F.col("weight"), F.col("most").cast("double"))).alias("target"))


def _draws(*key: object) -> np.random.Generator:
    return np.random.default_rng(zlib.crc32(repr(key).encode()))


def pivot(size: np.ndarray, mass: np.ndarray, draws: np.random.Generator) -> tuple[np.ndarray, int]:
    """Round all but one: 0 or 1 for each document, and the index of the one that stays fractional, -1 if none.

    ``mass`` is changed in place: that document's new mass.
    """
    up = np.zeros(len(size), np.int64)
    at = -1
    for j, u in enumerate(draws.random(len(size))):
        if mass[j] <= 1e-9 or mass[j] >= size[j] - 1e-9:
            up[j] = int(mass[j] > size[j] / 2)
            continue
        if at < 0:
            at = j
            continue
        rise, fall = min(size[at] - mass[at], mass[j]), min(mass[at], size[j] - mass[j])
        step = rise if u * (rise + fall) < fall else -fall
        mass[at] += step
        mass[j] -= step
        settled = []
        for i in (at, j):
            if mass[i] <= 1e-9 or mass[i] >= size[i] - 1e-9:
                up[i] = int(mass[i] > size[i] / 2)
                settled.append(i)
        at = -1 if len(settled) == 2 else j if settled == [at] else at
    return up, at


def _reduce(seed: int, level: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", *ORDER], ignore_index=True)
        mass = rows["mass"].to_numpy(float).copy()
        up, left = pivot(rows["size"].to_numpy(float), mass, _draws(seed, level, *key))
        open_ = np.arange(len(rows)) == left
        return rows.assign(mass=mass, up=np.where(open_, -1, up))

    return run


def _even_out(off: float, size: np.ndarray, up: np.ndarray, least: np.ndarray, most: np.ndarray) -> float:
    """Add or take copies, larger documents first, as long as that brings the remainder ``off`` nearer to nothing."""
    for i in range(len(size)):
        while size[i] and (step := 1 if off > 0 else -1) and least[i] <= up[i] + step <= most[i] and abs(off - step * size[i]) < abs(off):
            up[i] += step
            off -= step * size[i]
    return off


def _finish(seed: int, limit: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", *ORDER], ascending=[False, *[True] * len(ORDER)], ignore_index=True)
        size, mass, whole = rows["size"].to_numpy(float), rows["mass"].to_numpy(float).copy(), rows["whole"].to_numpy()
        draws = _draws(seed, "last", *key)
        want = mass.sum()
        up, left = pivot(size, mass, draws)
        if left >= 0:
            up[left] = int(draws.random() * size[left] < mass[left])
        off = _even_out(want - (up * size).sum(), size, up, np.zeros(len(up)), np.ones(len(up)))
        # what whole numbers next to the average can't reach, other numbers of copies may
        _even_out(off, size, up, -whole, limit - whole)
        return rows.assign(mass=mass, up=up)

    return run


def _key(docs: DataFrame) -> list:
    """The columns ``doc_id, source, size, content`` of ``docs``; rows that agree in these are equal in all columns that can be hashed."""
    known = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), size.alias("size"), F.xxhash64(*known, *(c.isNull() for c in known)).alias("content")]


def _mixed(sizes: DataFrame, weights: tuple[int, ...], limit: int, seed: int) -> DataFrame:
    """``(doc_id, source, size, content, source_size, target, copies)`` for every row of ``sizes(doc_id, source, size, content)``."""
    sizes = cut(sizes)
    aims = cut(targets(sizes, weights, limit))
    rate = F.when(F.col("s.source_size") > 0, F.col("s.target") / F.col("s.source_size")).otherwise(0.0)
    apart = sizes.groupBy("doc_id", "source", "size", "content").agg(F.count("*").alias("n")).select("doc_id", "source", "size", "content", F.explode(F.expr("sequence(1L, n)")).alias("turn"))
    node = F.expr(f"pmod(xxhash64(d.doc_id, d.content, d.turn, {seed}), cast(ceil(s.n / {FAN}) as bigint))").alias("node")
    rows = cut(apart.alias("d").join(aims.alias("s"), F.expr("d.source <=> s.source")).select("d.doc_id", "d.source", "size", "content", "turn", F.floor(rate).alias("whole"), (F.col("size") * (rate - F.floor(rate))).alias("mass"), F.lit(0).cast("long").alias("up"), node))
    loose = (F.col("mass") > 1e-9) & (F.col("mass") < F.col("size") - 1e-9)
    settled = rows.filter(~loose).withColumn("up", F.expr("cast(mass > size / 2 as bigint)"))
    work, reserve = rows.filter(loose & (F.col("node") > 0)), rows.filter(loose & (F.col("node") == 0))
    nodes = aims.agg(F.max(F.ceil(F.col("n") / FAN))).first()[0] or 0
    level = 0
    while nodes > 1:
        done = cut(work.groupBy("source", "node").applyInPandas(_reduce(seed, level), ROW))
        settled = settled.unionAll(done.filter("up >= 0"))
        work = done.filter("up < 0").withColumn("node", F.expr(f"node div {FAN}"))
        nodes, level = (-(-nodes // FAN), level + 1)
    last = work.unionAll(reserve).groupBy("source").applyInPandas(_finish(seed, limit), ROW)
    out = settled.unionAll(last).alias("d").join(aims.alias("s"), F.expr("d.source <=> s.source"))
    return out.select("doc_id", "d.source", "size", "content", "source_size", "target", (F.col("whole") + F.col("up")).alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = LIMIT, seed: int = 17) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` for every row of ``docs(doc_id, text, source)``."""
    plain = pick(docs, "doc_id", "source", "text")
    mixed = _mixed(plain.select(*_key(plain)), weights, limit, seed)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def take(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = LIMIT, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Texts are shuffled once, to the copies of their row. Equal rows are told apart by nothing, so they share their copies: one of them is written as often as all are taken, in runs of up to RUN copies
    that Spark can deal out.
    """
    key = F.struct("doc_id", "source", "size", "content").alias("mix_key")
    picked = cut(_mixed(docs.select(*_key(docs)), weights, limit, seed).groupBy(key).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).filter("copies > 0"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.struct(*_key(docs)).alias("mix_key"))
    again = F.explode(F.expr("sequence(1L, copies)"))
    out = rows.join(picked.filter("rows = 1"), "mix_key").select("row", again).select("row.*")
    if not picked.filter("rows > 1").isEmpty():
        runs = picked.filter("rows > 1").select("mix_key", F.explode(F.expr(f"transform(sequence(0L, (copies - 1) div {RUN}), i -> least({RUN}L, copies - i * {RUN}))")).alias("copies"))
        one = rows.join(picked.filter("rows > 1").select("mix_key"), "mix_key", "left_semi").groupBy("mix_key").agg(F.first("row").alias("row"))
        out = out.unionAll(one.join(runs, "mix_key").select("row", again).select("row.*"))
    return out
