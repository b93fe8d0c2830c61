"""Exact top-k search by inner product with a pivot-distance index.

Vectors become integers, floor(scale * x). A further coordinate that fills every vector up to the largest norm turns the largest inner product into
the least Euclidean distance. Each vector is keyed by its nearest pivot and its distance to it; the distances of a pivot are cut into rings. A query
first searches the ring it would itself lie in, which gives a bound; then it visits just those rings that the triangle inequality doesn't rule out with
that bound, and within each the sorted annulus around its own distance. The bound is inclusive, so ties are complete.

The number of rings grows with the vectors, about ``RING`` to a ring, and beyond some millions of vectors with four times their square root. A ring is searched in blocks of about ``BLOCK`` vectors, each
with up to about ``QUERIES`` of the queries that visit it at a time; so a block is sent once for every that many visits, and not at all if no query visits it.

Pivots come from a sample of at most ``sample`` vectors (the first by a hash of vec_id); all vectors are indexed, and the result is exact whatever the pivots are. Vectors that are null or hold
null or non-finite components, and rows without vec_id, take no part. Shorter vectors count as filled up with zeros. Every row is a vector of its own, also where rows share a vec_id:
such rows are numbered in the order of their vec_id, each asks for itself and is a candidate for the others. Extra columns are ignored. Scores are exact in 64 bits: where the squares of a vector's integers may sum to 2^53 or more, integers are multiplied instead of doubles; sums of 2^63 and more are an
error of Spark's arithmetic.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fissure.llm._common import cut

#: Vectors of a ring at which it is aimed, vectors of one searched block, queries of one searched block.
RING, BLOCK, QUERIES = 512, 8192, 4096
#: The bound of a query that has none yet.
NONE = -(1 << 63)


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, v)``: the vectors that take part, as integers."""
    ok = F.expr("vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return vectors.filter(ok).select("vec_id", F.expr(f"transform(embedding, x -> cast(floor({scale} * cast(x as double)) as bigint))").alias("v"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros, in double precision, for distances."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), size))
    out[np.arange(size) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _lifted(m: np.ndarray, norm: float) -> np.ndarray:
    return np.concatenate([m, np.sqrt(np.maximum(0, norm - (m * m).sum(1)))[:, None]], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T))


def choose_pivots(sample: np.ndarray, k: int) -> np.ndarray:
    """Means of a few rounds of k-means that begin with mutually distant vectors."""
    chosen = [0]
    near = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(k, len(sample)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(sample, sample[chosen[-1:]])[:, 0])
    pivots = sample[chosen]
    for _ in range(5):
        of = _distances(sample, pivots).argmin(1)
        pivots = np.stack([sample[of == i].mean(0) if (of == i).any() else p for i, p in enumerate(pivots)])
    return pivots


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k largest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def _padded(rows: pd.Series, size: int, kind: type) -> np.ndarray:
    return np.stack([np.pad(np.asarray(v, kind), (0, size - len(v))) for v in rows])


def _search(k: int, size: int, kind: type):
    """Search one block for some of the queries that visit it. ``kind``: numbers in which inner products are exact."""

    def run(key: tuple, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(block):
            block = block.sort_values("dist", ignore_index=True)
            ids, dist = block["vec_id"].to_numpy(), block["dist"].to_numpy()
            m, q = _padded(block["v"], size, kind), _padded(queries["v"], size, kind)
            low = np.searchsorted(dist, queries["low"].to_numpy(), side="left")
            high = np.searchsorted(dist, queries["high"].to_numpy(), side="right")
            bounds, names = queries["bound"].to_numpy(), queries["query_id"].to_numpy()
            for at in range(0, len(q), 64):
                a, b = low[at : at + 64].min(), max(low[at : at + 64].min(), high[at : at + 64].max())
                scores = (q[at : at + 64] @ m[a:b].T).astype(np.int64)
                for i, row in enumerate(scores, at):
                    # beyond the query's own annulus nothing can reach its bound, so the bound alone decides
                    reach = np.flatnonzero((row >= bounds[i]) & (ids[a:b] != names[i]))
                    best = reach[_best(ids[a:b][reach], row[reach], k)]
                    out += [(names[i], x, s) for x, s in zip(ids[a:b][best].tolist(), row[best].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, sample: int = 4096) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the vectors of ``vectors(vec_id, embedding)`` where the column ``is_query`` holds."""
    whole = cut(integers(vectors, scale).withColumn("asked", F.coalesce(is_query, F.lit(False))))
    if not whole.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        # the second key lets the sort split rows of one id; numbers rise with the ids, so ties fall as they do by id
        numbered = cut(whole.withColumn("turn", F.monotonically_increasing_id()).orderBy("vec_id", "turn").withColumn("row", F.monotonically_increasing_id()))
        found = _search_all(numbered.select(F.col("row").alias("vec_id"), "v", "asked"), k, sample)
        names = numbered.select("row", F.col("vec_id").alias("name"))
        found = found.join(names.select(F.col("row").alias("query_id"), F.col("name").alias("query")), "query_id").join(names.select(F.col("row").alias("vec_id"), "name"), "vec_id")
        return found.select(F.col("query").alias("query_id"), "rank", F.col("name").alias("vec_id"), "score")
    return _search_all(whole, k, sample)


def _search_all(whole: DataFrame, k: int, sample: int) -> DataFrame:
    """``top_k`` of ``whole(vec_id, v, asked)``, in which no vec_id repeats."""
    facts = whole.agg(F.count("*"), F.max(F.size("v")), F.max(F.expr("aggregate(v, 0L, (s, x) -> s + x * x)")), F.count_if("asked")).first()
    n, size, largest, asked = facts[0], facts[1] or 0, facts[2] or 0, facts[3]
    norm, kind = float(largest), float if largest < 1 << 53 else np.int64
    #: what rounding may change in a distance
    slack = 1e-3 + 1e-6 * norm**0.5
    rings = max(1, round(min(n / RING, 4 * n**0.5) ** 0.5))
    turned = whole.withColumn("turn", F.expr("pmod(xxhash64(vec_id), 1000000)"))
    # a part that holds about, and in the end at most, ``sample`` vectors
    some = (turned.filter(F.col("turn") < int(1_020_000 * sample / n)) if n > sample else turned).toPandas().sort_values(["turn", "vec_id"], ignore_index=True)[:sample]
    pivots = choose_pivots(_lifted(_padded(some["v"], size, float), norm) if len(some) else np.zeros((1, size + 1)), rings)

    def key(batches):
        for batch in batches:
            d = _distances(_lifted(_matrix(batch.column("v"), size), norm), pivots)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32()), pa.array(d[np.arange(len(d)), near], pa.float64())], names=["vec_id", "v", "asked", "pivot", "dist"])

    keyed = cut(whole.mapInArrow(key, "vec_id long, v array<long>, asked boolean, pivot int, dist double"))
    shares = ", ".join(str((i + 1) / rings) for i in range(rings - 1))
    edges = {r["pivot"]: np.array(r["e"]) for r in keyed.groupBy("pivot").agg(F.expr(f"percentile_approx(dist, array({shares}))").alias("e")).collect()} if rings > 1 else {}

    def rung(batch: pa.RecordBatch) -> np.ndarray:
        """The number of each vector's ring."""
        pivot, dist = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("pivot", "dist"))
        out = pivot.astype(np.int64) * rings
        for at, limits in edges.items():
            rows = np.flatnonzero(pivot == at)
            out[rows] += np.searchsorted(limits, dist[rows], side="left")
        return out

    def ring(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(rung(batch), pa.int32()), batch.column("dist")], names=["cell", "dist"])

    found = keyed.select("pivot", "dist").mapInArrow(ring, "cell int, dist double").groupBy("cell").agg(F.min("dist"), F.max("dist"), F.count("*")).orderBy("cell").collect()
    if not found:
        return whole.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    names = np.array([r[0] for r in found])
    p, near, far = names // rings, np.array([r[1] for r in found]), np.array([r[2] for r in found])
    salts = -(-np.array([r[3] for r in found]) // BLOCK)

    def visits(column: pa.Array, bound: np.ndarray, home: bool):
        """Each query's rings: its own, or all others that its bound leaves. Yields the queries, their rings' numbers, the distances to the rings' pivots, and the radius."""
        step = max(1, (1 << 21) // len(p))
        for at in range(0, len(column), step):
            m = _matrix(column.slice(at, step), size)
            d = _distances(_lifted(m, norm) * np.append(np.ones(size), 0.0), pivots)
            own = d.argmin(1)
            gap = np.maximum(0, np.maximum(d[:, p] - far, near - d[:, p]))
            at_home = np.zeros(gap.shape, bool)
            inside = np.where(p == own[:, None], gap, np.inf)
            at_home[np.arange(len(m)), np.where(np.isfinite(inside).any(1), inside.argmin(1), gap.argmin(1))] = True
            b = bound[at : at + step]
            radius = np.where(b == NONE, np.inf, np.sqrt(np.maximum(0, (m * m).sum(1) + norm - 2.0 * b)) + slack)
            apart = np.maximum(gap, (d[:, p] - d[np.arange(len(m)), own][:, None]) / 2)
            q, c = np.nonzero(at_home if home else ~at_home & (apart <= radius[:, None]))
            yield q + at, c, d[q, p[c]], radius[q]

    def spread(queries: DataFrame, home: bool) -> DataFrame:
        """Answers of the blocks that the queries visit."""

        def count(batches):
            for batch in batches:
                bound = batch.column("bound").to_numpy(zero_copy_only=False)
                seen = sum((np.bincount(c, minlength=len(p)) for _, c, _, _ in visits(batch.column("v"), bound, home)), np.zeros(len(p), np.int64))
                c = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(seen[c], pa.int64())], names=["cell", "n"])

        parts = np.ones(len(p), np.int64)
        if asked > QUERIES:
            parts[:] = 0
            for r in queries.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
                parts[r[0]] = -(-r[1] // QUERIES)

        def visit(batches):
            for batch in batches:
                ids, bound = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("vec_id", "bound"))
                for q, c, d, radius in visits(batch.column("v"), bound, home):
                    times = salts[c]
                    q, c, d, radius = (np.repeat(x, times) for x in (q, c, d, radius))
                    salt = np.arange(len(c)) - np.repeat(np.cumsum(times) - times, times)
                    part = (_hashed(ids[q]) % parts[c].astype(np.uint64)).astype(np.int32)
                    take = pa.array(q)
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(take), batch.column("v").take(take), pa.array(bound[q]), pa.array(d - radius), pa.array(d + radius), pa.array(c, pa.int32()), pa.array(salt, pa.int32()), pa.array(part)], names=["query_id", "v", "bound", "low", "high", "cell", "salt", "part"])

        def place(batches):
            for batch in batches:
                c = np.searchsorted(names, rung(batch))
                salt = _hashed(batch.column("vec_id").to_numpy(zero_copy_only=False)) // np.uint64(7) % salts[c].astype(np.uint64)
                row = np.repeat(np.arange(len(c)), parts[c])
                part = np.arange(len(row)) - np.repeat(np.cumsum(parts[c]) - parts[c], parts[c])
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(batch.column(x).take(take) for x in ("vec_id", "v", "dist")), pa.array(c[row], pa.int32()), pa.array(salt[row], pa.int32()), pa.array(part, pa.int32())], names=["vec_id", "v", "dist", "cell", "salt", "part"])

        there = queries.mapInArrow(visit, "query_id long, v array<long>, bound long, low double, high double, cell int, salt int, part int")
        blocks = keyed.mapInArrow(place, "vec_id long, v array<long>, dist double, cell int, salt int, part int")
        by = ["cell", "salt", "part"]
        return there.groupBy(*by).cogroup(blocks.groupBy(*by)).applyInPandas(_search(k, size, kind), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    queries = keyed.filter("asked").select("vec_id", "v")
    first = cut(spread(queries.withColumn("bound", F.lit(NONE)), True).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k))
    bounds = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    bounded = queries.join(bounds, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(NONE)))
    answers = spread(bounded, False).unionAll(first.drop("rank"))
    return answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _hashed(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x >> np.uint64(20)
