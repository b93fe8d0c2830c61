"""Representatives of groups by k-means over embeddings."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fissure.operators import sampling
from fissure.session import shared

#: Rows of a group up to which one task clusters it. Larger groups are clustered as a whole too, by passes over all their rows.
SHARD = 5000
STARTS, ROUNDS = 10, 50
#: Of large groups: rounds in which candidates are drawn, how many times the centers a round draws, passes in which centers move, and bytes of candidates that are sent at a time.
SEEDING, OVERSAMPLE, STEPS, SENT = 4, 2, 10, 64 << 20


def kmeans(x: np.ndarray, k: int, seed: int = 42, starts: int = STARTS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centers and assignment with the least inertia of several k-means++ starts."""
    r, best = np.random.default_rng(seed), (np.inf, x[:1], np.zeros(len(x), int))
    for _ in range(starts):
        centers = x[r.integers(len(x))][None]
        least = ((x - centers[0]) ** 2).sum(1)
        while len(centers) < k:
            centers = np.concatenate([centers, x[r.choice(len(x), p=least / least.sum()) if least.sum() > 0 else r.integers(len(x))][None]])
            least = np.minimum(least, ((x - centers[-1]) ** 2).sum(1))
        of = np.full(len(x), -1)
        for _ in range(rounds):
            d = (x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1)[None]
            now = d.argmin(1)
            if (now == of).all():
                break
            of = now
            centers = np.stack([x[of == i].mean(0) if (of == i).any() else c for i, c in enumerate(centers)])
        inertia = d[np.arange(len(x)), of].sum()
        if inertia < best[0]:
            best = (inertia, centers, of)
    return best[1], best[2]


def nearest(x: np.ndarray, centers: np.ndarray, of: np.ndarray) -> list[int]:
    """The member of each cluster that is nearest to its center, the first of ties; empty clusters give none."""
    picks = []
    for i, c in enumerate(centers):
        members = np.flatnonzero(of == i)
        if len(members):
            picks.append(int(members[np.argmin(((x[members] - c) ** 2).sum(1))]))
    return picks


def weighted(x: np.ndarray, weight: np.ndarray, k: int, seed: int, starts: int = STARTS, rounds: int = ROUNDS) -> np.ndarray:
    """Centers with the least inertia of several k-means++ starts over points that stand for ``weight`` rows each."""
    if len(x) <= k:
        return x
    r, best = np.random.default_rng(seed), (np.inf, x[:k])
    for _ in range(starts):
        centers = x[r.choice(len(x), p=weight / weight.sum())][None]
        least = ((x - centers[0]) ** 2).sum(1)
        while len(centers) < k:
            mass = least * weight
            centers = np.concatenate([centers, x[r.choice(len(x), p=mass / mass.sum()) if mass.sum() > 0 else r.integers(len(x))][None]])
            least = np.minimum(least, ((x - centers[-1]) ** 2).sum(1))
        of = np.full(len(x), -1)
        for _ in range(rounds):
            d = distances(x, centers)
            now = d.argmin(1)
            if (now == of).all():
                break
            of = now
            centers = np.stack([np.average(x[of == i], axis=0, weights=weight[of == i]) if (of == i).any() else c for i, c in enumerate(centers)])
        inertia = (d[np.arange(len(x)), of] * weight).sum()
        if inertia < best[0]:
            best = (inertia, centers)
    return best[1]


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, of differences, so that equal points are at 0; a block of rows at a time."""
    out = np.empty((len(x), len(centers)))
    for i, c in enumerate(centers):
        out[:, i] = ((x - c) ** 2).sum(1)
    return out


def representatives(rows: DataFrame, group: list[str], n: int, seed: int = 42) -> DataFrame:
    """(group, row_id) of up to ``n`` representatives of each group of ``rows(group, row_id, embedding)``.

    Groups of up to ``n`` rows stay whole. Rows without an embedding take no part. A group of up to SHARD rows is clustered by one task, with k-means++ starts; a larger one by passes of all tasks over its rows, as ``_whole`` says. Nulls in groups are a group.
    """
    rows = rows.filter("embedding is not null").select(*group, "row_id", "embedding")
    schema = rows.select(*group, "row_id").schema
    # a null has no field here
    keyed = rows.withColumn("gid", F.to_json(F.struct(*group)))
    counts = keyed.groupBy("gid").agg(F.count("*").alias("group_size"), F.max(F.size("embedding")).alias("dim"))
    most = max(SHARD, n)

    def pick(part: pd.DataFrame) -> pd.DataFrame:
        if len(part) > n:
            part = part.sort_values("row_id", ignore_index=True)
            part = part.iloc[sorted(nearest(x := np.stack(part["embedding"].to_numpy()).astype(float), *kmeans(x, n, seed)))]
        return part[[*group, "row_id"]]

    small = keyed.join(counts.filter(F.col("group_size") <= most).select("gid"), "gid").groupBy("gid").applyInPandas(pick, schema)
    large = counts.filter(F.col("group_size") > most)
    found, dim = large.agg(F.count("*"), F.max("dim")).first()
    if not found:
        return small
    # centers that are sent to all tasks at a time stay below SENT bytes; more groups take turns
    turns = -(-found * (SEEDING * OVERSAMPLE + 1) * n * dim * 8 // SENT)
    path = shared(rows.sparkSession, "clusters")
    turn = F.pmod(F.xxhash64("gid"), F.lit(turns)).alias("turn")
    wide = keyed.join(large.select("gid"), "gid").select(turn, *group, "gid", "row_id", F.col("embedding").cast("array<double>").alias("embedding"))
    wide.sortWithinPartitions("gid", "row_id").write.partitionBy("turn").parquet(path)
    for i in [r["turn"] for r in rows.sparkSession.read.parquet(path).select("turn").distinct().collect()]:
        mine = rows.sparkSession.read.parquet(path).filter(F.col("turn") == i)
        picked = _whole(mine.select("gid", "row_id", "embedding"), n, seed)
        small = small.unionByName(mine.join(picked, ["gid", "row_id"], "left_semi").select(*group, "row_id"))
    return small


def _whole(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """(gid, row_id) of ``n`` representatives of each group of ``rows(gid, row_id, embedding)``, by k-means||.

    Candidates are drawn in SEEDING rounds, each of about OVERSAMPLE * n rows, in proportion to their squared distance to those drawn so far; they are weighted by the rows nearest to them and clustered among themselves, which gives
    the first centers. These move for at most STEPS passes over all rows, of which tasks send sums. How many passes there are depends neither on ``n`` nor on the rows.
    """
    spark = rows.sparkSession

    def each(kernel: Callable, schema: str, centers: dict[str, np.ndarray]) -> DataFrame:
        """``kernel(rows' ids, their vectors, centers)`` of the rows of a group, a batch at a time, as (gid, part, *values)."""
        sent = spark.sparkContext.broadcast(centers)
        columns = [f.split()[0] for f in f"gid string, part long, {schema}".split(", ")]

        def run(frames):
            part = TaskContext.get().partitionId() << 32
            for turn, frame in enumerate(frames):
                for gid, mine in frame.groupby("gid"):
                    out = kernel(mine["row_id"].to_numpy(), np.stack(mine["embedding"].to_numpy()), sent.value[gid])
                    if out:
                        yield pd.DataFrame([(gid, part + turn, *v) for v in out], columns=columns)

        return rows.mapInPandas(run, f"gid string, part long, {schema}")

    def cost(ids, x, centers):
        return [(float(distances(x, centers).min(1).sum()),)]

    def weights(ids, x, centers):
        return [(i, int(k)) for i, k in enumerate(np.bincount(distances(x, centers).argmin(1), minlength=len(centers))) if k]

    def sums(ids, x, centers):
        of = distances(x, centers).argmin(1)
        return [(int(i), int((of == i).sum()), x[of == i].sum(0).tolist()) for i in np.unique(of)]

    def first(ids, x, centers):
        d = distances(x, centers)
        of = d.argmin(1)
        best = [min(np.flatnonzero(of == i), key=lambda j: (d[j, i], ids[j])) for i in np.unique(of)]
        return [(int(of[j]), float(d[j, of[j]]), int(ids[j])) for j in best]

    start = rows.groupBy("gid").agg(F.min_by("embedding", F.struct(sampling.shuffled(seed), "row_id")).alias("c")).collect()
    centers = {r["gid"]: np.array([r["c"]]) for r in start}
    for round_ in range(SEEDING):
        total = {r["gid"]: r["total"] for r in each(cost, "cost double", centers).groupBy("gid").agg(F.sum("cost").alias("total")).collect()}
        drawn = each(_drawn(round_, seed, OVERSAMPLE * n), "row_id long, embedding array<double>", {g: (c, total[g]) for g, c in centers.items()}).select("gid", "row_id", "embedding").collect()
        more: dict[str, list] = {}
        for r in sorted(drawn, key=lambda r: r["row_id"]):
            more.setdefault(r["gid"], []).append(r["embedding"])
        centers |= {g: np.concatenate([centers[g], np.array(x)]) for g, x in more.items()}
    count = each(weights, "center int, n long", centers).groupBy("gid", "center").agg(F.sum("n").alias("n")).collect()
    weight = {g: np.zeros(len(c)) for g, c in centers.items()}
    for r in count:
        weight[r["gid"]][r["center"]] = r["n"]
    sent = spark.sparkContext.broadcast({g: (c, weight[g]) for g, c in centers.items()})

    def among(frames):
        for frame in frames:
            yield pd.DataFrame({"gid": frame["gid"], "centers": [weighted(*sent.value[g], n, seed).tolist() for g in frame["gid"]]})

    named = spark.createDataFrame([(g,) for g in sorted(centers)], "gid string").repartition(min(len(centers), 64))
    centers = {r["gid"]: np.array(r["centers"]) for r in named.mapInPandas(among, "gid string, centers array<array<double>>").collect()}

    def total_of(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("part")
        return part.iloc[:1].assign(n=part["n"].sum(), total=[np.stack(part["total"].to_numpy()).sum(0).tolist()])

    for _ in range(STEPS):
        kind = "center int, n long, total array<double>"
        moved = {g: c.copy() for g, c in centers.items()}
        for r in each(sums, kind, centers).groupBy("gid", "center").applyInPandas(total_of, f"gid string, part long, {kind}").collect():
            moved[r["gid"]][r["center"]] = np.array(r["total"]) / r["n"]
        still = all(np.allclose(moved[g], c, rtol=1e-6, atol=1e-9) for g, c in centers.items())
        centers = moved
        if still:
            break
    return each(first, "center int, d double, row_id long", centers).groupBy("gid", "center").agg(F.min_by("row_id", F.struct("d", "row_id")).alias("row_id")).select("gid", "row_id")


def _drawn(round_: int, seed: int, many: int) -> Callable:
    """Rows that are drawn: about ``many`` of a group, by a hash of the row number."""

    def kernel(ids, x, sent):
        centers, total = sent
        u = np.array([int.from_bytes(hashlib.md5(f"{seed}:{round_}:{i}".encode()).digest()[:7]) / (1 << 56) for i in ids])
        return [(int(ids[j]), x[j].tolist()) for j in np.flatnonzero(u * total < many * distances(x, centers).min(1))]

    return kernel


def with_embeddings(rows: DataFrame, embeddings: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the embedding of the same ``keys``; rows without one have null, and a key that has several is an error of the caller's."""
    return rows.join(embeddings.select(*keys, "embedding"), keys, "left")


def select(rows: DataFrame, group: list[str], n: int, method: str = "kmeans", stratum: str = "source", seed: int = 42) -> DataFrame:
    """k-means where every row of a group has an embedding, else a stratified sample; every other method is stratified too."""
    if method != "kmeans":
        return sampling.capped(rows, group, stratum, n, seed)
    whole = rows.groupBy(*group).agg(F.count("*").alias("all"), F.count("embedding").alias("with")).filter("all = with").select(*group)
    picked = representatives(sampling.joined(rows, whole, group, "left_semi"), group, n, seed)
    return sampling.joined(rows, picked.select(*group, "row_id"), [*group, "row_id"], "left_semi").unionByName(sampling.capped(sampling.joined(rows, whole, group, "left_anti"), group, stratum, n, seed))


def tiered(rows: DataFrame, group: list[str], n: int = 10, least: int = 100, seed: int = 42) -> DataFrame:
    """Groups of ``least`` rows and more by k-means over the whole group; smaller ones, and those with an embedding that can't be clustered, give up to ``n`` random rows.

    An embedding is missing, empty, of another length than others of its group, or has a value that is missing or not finite.
    """
    fit = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    counts = rows.groupBy(*group).agg(F.count("*").alias("all"), F.min(fit).alias("fit"), F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high"))
    whole = counts.filter((F.col("all") >= least) & F.col("fit") & (F.col("low") == F.col("high")) & (F.col("low") > 0)).select(*group)
    picked = representatives(sampling.joined(rows, whole, group, "left_semi"), group, n, seed)
    return sampling.joined(rows, picked, [*group, "row_id"], "left_semi").unionByName(sampling.random(sampling.joined(rows, whole, group, "left_anti"), group, n, seed))


def embed(rows: DataFrame, embedder: Callable[[list[str]], Iterable], cache: DataFrame | None = None, batch: int = 64) -> DataFrame:
    """(text_hash, embedding) of the distinct texts of ``rows(text)`` that ``cache`` doesn't have, and those of the cache.

    A text whose embedding fails three times has a null embedding.
    """
    keyed = rows.select("text", F.sha2("text", 256).alias("text_hash")).dropDuplicates(["text_hash"])
    todo = keyed.join(cache.select("text_hash"), "text_hash", "left_anti") if cache is not None else keyed

    def run(frames):
        for frame in frames:
            out: list = []
            texts = frame["text"].tolist()
            for at in range(0, len(texts), batch):
                part, got = texts[at : at + batch], None
                for _ in range(3):
                    try:
                        got = [None if v is None else list(map(float, v)) for v in embedder(part)]
                        break
                    except Exception:  # noqa: BLE001  the embedder is the caller's
                        got = None
                out += got if got is not None and len(got) == len(part) else [None] * len(part)
            yield pd.DataFrame({"text_hash": frame["text_hash"], "embedding": out})

    new = todo.mapInPandas(run, "text_hash string, embedding array<float>")
    return new.unionByName(cache.select("text_hash", "embedding")) if cache is not None else new
