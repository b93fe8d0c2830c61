"""SimHash near-duplicate detection with multi-index hashing.

A document's fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of its 3-word shingles. Fingerprints that differ in
at most ``DISTANCE`` bits are linked. They are cut into two 32-bit segments; by the pigeonhole principle a linked pair agrees in
one segment up to one bit. That ball is enumerated from one side only: the fingerprint whose bit is 0 looks up the value with
the bit set. Matches of the segment table are verified over all 64 bits.

A segment value that more than ``BUCKET`` fingerprints share (many near copies of one text) is not joined pair by pair. Its members are
keyed again by the 16-bit halves of the other segment in the same way; each resulting group agrees, up to a bit each, on 48 of 64
bits, and returns a spanning forest of its links instead of the links themselves. A group of more than ``CROWD`` is keyed once more, by the 8-bit halves of the 16 bits that are left. No link between different
fingerprints is lost.

Null and empty texts have no words and the fingerprint zero, which is linked like any other. Null doc_ids are kept; a component's id is
its smallest doc_id that is not null. Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import starmap

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fissure.llm._common import cut, map_text, merged, pick
from fissure.llm.components import connected_components

DISTANCE = 3
SHINGLE = 3
SEED = 42
#: Fingerprints with one segment value that are still joined pair by pair.
BUCKET = 64
#: Fingerprints that one task compares with each other.
CROWD = 2048
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(SHINGLE, n) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(starmap(lambda i, j: digest(joined[i:j], SEED), zip(starts[: n - k].tolist(), ends[k:].tolist(), strict=True)), "<u8", n - k)
    ones = np.zeros(64, np.int64)
    for at in range(0, n - k, 65536):
        ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n - k, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` of ``docs(doc_id, text)``."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([fingerprint(x) for x in batch.column("text").to_pylist()], pa.int64())], names=["doc_id", "fp"])

    return map_text(pick(docs, "doc_id", "text"), kernel, "doc_id long, fp long")


def _ball(value: str, bits: int) -> str:
    """SQL array of ``value`` and all values with one more of its low bits set."""
    return f"concat(array({value}), filter(transform(sequence(0, {bits - 1}), b -> {value} | shiftleft(1L, b)), x -> x <> {value}))"


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each fingerprint to the smallest it is connected with in this group, which is compared in blocks."""
    label = np.arange(len(fps))
    step = max(1, (1 << 22) // max(1, len(fps)))
    while True:
        before = label.copy()
        for at in range(0, len(fps), step):
            i, j = np.nonzero(np.bitwise_count(fps[at : at + step, None] ^ fps[None, :]) <= DISTANCE)
            np.minimum.at(label, i + at, label[j])
        label = label[label]
        if (label == before).all():
            break
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_forest(np.sort(x.values.to_numpy(zero_copy_only=False)).view(np.uint64)) for x in batch.column("fps")]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64), pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])


def links(fps: DataFrame) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``fps(fp)`` that connect what lies within DISTANCE bits."""
    halves = fps.select("fp", F.explode(F.expr("array(fp & 4294967295L, shiftrightunsigned(fp, 32) | 4294967296L)")).alias("key"))
    probes = fps.select("fp", F.explode(F.expr(f"concat({_ball('(fp & 4294967295L)', 32)}, transform({_ball('shiftrightunsigned(fp, 32)', 32)}, x -> x | 4294967296L))")).alias("key"))
    counts = halves.groupBy("key").agg(F.count("*").alias("n"))
    table = halves.join(merged(counts.filter(F.col("n") <= BUCKET)), "key").select("key", F.col("fp").alias("other")).unionAll(counts.filter(F.col("n") > BUCKET).select("key", F.lit(None).cast("long")))
    met = cut(probes.join(merged(table), "key").filter(f"other is null or (fp <> other and bit_count(fp ^ other) <= {DISTANCE})"))
    near = met.filter("other is not null").select(F.col("fp").alias("a"), F.col("other").alias("b"))
    rest = "(case when key < 4294967296L then shiftrightunsigned(fp, 32) else fp & 4294967295L end)"
    again = (
        met.filter("other is null")
        .select("fp", "key", F.expr(f"{rest} & 65535L").alias("low"), F.expr(f"shiftrightunsigned({rest}, 16)").alias("high"))
        .select("fp", "key", F.explode(F.expr(f"concat({_ball('low', 16)}, transform({_ball('high', 16)}, x -> x | 65536L))")).alias("part"))
    )
    again = cut(again.distinct())
    crowds = again.groupBy("key", "part").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("key", "part")
    few = again.join(merged(crowds), ["key", "part"], "left_anti").groupBy("key", "part").agg(F.collect_set("fp").alias("fps"))
    left = f"(case when part < 65536L then shiftrightunsigned({rest}, 16) else {rest} & 65535L end)"
    third = (
        again.join(merged(crowds), ["key", "part"])
        .select("fp", "key", "part", F.expr(f"{left} & 255L").alias("low"), F.expr(f"shiftrightunsigned({left}, 8)").alias("high"))
        .select("fp", "key", "part", F.explode(F.expr(f"concat({_ball('low', 8)}, transform({_ball('high', 8)}, x -> x | 256L))")).alias("last"))
    )
    # a group agrees on 56 bits up to one bit of each part, so it has at most 256 * 33 * 17 * 9 fingerprints; the halves of the last 8 bits and a bit each leave 16 * 33 * 17 * 9 * 5 at most
    packed = cut(third.distinct().join(merged(third.groupBy("key", "part", "last").agg(F.approx_count_distinct("fp").alias("n")).withColumn("crowded", F.col("n") > CROWD).drop("n")), ["key", "part", "last"]))
    many = packed.filter("not crowded").groupBy("key", "part", "last").agg(F.collect_set("fp").alias("fps"))
    end = f"(case when last < 256L then shiftrightunsigned({left}, 8) else {left} & 255L end)"
    most = (
        packed.filter("crowded")
        .select("fp", "key", "part", "last", F.expr(f"{end} & 15L").alias("low"), F.expr(f"shiftrightunsigned({end}, 4)").alias("high"))
        .select("fp", "key", "part", "last", F.explode(F.expr(f"concat({_ball('low', 4)}, transform({_ball('high', 4)}, x -> x | 16L))")).alias("end"))
        .groupBy("key", "part", "last", "end").agg(F.collect_set("fp").alias("fps"))
    )
    groups = few.select("fps").unionAll(many.select("fps")).unionAll(most.select("fps")).filter("size(fps) > 1")
    return near.unionAll(groups.mapInArrow(_forests, "a long, b long")).distinct()


def _components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` of every row, and ``(fp, root, component_id)`` of every fingerprint."""
    each = cut(fingerprints(docs))
    roots = connected_components(links(each.select("fp").distinct()))
    least = each.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(merged(roots), F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return each, rooted.join(merged(of), "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, fingerprint, component_id)`` for every row of ``docs(doc_id, text)``."""
    each, by_fp = _components(docs)
    return each.join(merged(by_fp), "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without all but one document of each component: one whose doc_id is the component's id.

    Of repeated rows of that doc_id one stays, and where they hold different texts, one of the component's; where a component has no doc_id at all, one of its rows stays. Texts are shuffled only of rows whose doc_id is missing or repeats.
    """
    each, by_fp = _components(docs)
    found = cut(each.join(merged(by_fp), "fp").filter("doc_id <=> component_id").groupBy("root").agg(F.min("component_id").alias("id"), F.min("fp").alias("fp")))
    twice = cut(each.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"))
    several, missing = not twice.isEmpty(), not found.filter("id is null").isEmpty()
    # the caller's columns are joined under numbers, so that no name of theirs meets one of ours
    rows = docs.toDF(*map(str, range(len(docs.columns))))
    own = [F.col(f"`{i}`") for i in range(len(docs.columns))]
    id_ = F.col(f"`{docs.columns.index('doc_id')}`")
    ids = found.filter("id is not null").select(F.col("id").alias("kept id"), F.col("fp").alias("kept fp"))
    repeated = twice.select(F.col("doc_id").alias("repeated id"))
    once = ids.join(merged(repeated), F.col("kept id") == F.col("repeated id"), "left_anti") if several else ids
    kept = rows.join(merged(once), id_ == F.col("kept id"), "left_semi")
    if several:
        marked = _fingerprinted(rows.join(merged(repeated), id_ == F.col("repeated id"), "left_semi"), docs.columns.index("text"))
        marked = marked.join(merged(ids), (id_ == F.col("kept id")) & (F.col(MARK) == F.col("kept fp")), "left_semi").dropDuplicates([str(docs.columns.index("doc_id")), MARK])
        kept = kept.unionAll(marked.select(own))
    if missing:
        nameless = found.filter("id is null").select(F.col("fp").alias("kept fp"))
        marked = _fingerprinted(rows.filter(id_.isNull()), docs.columns.index("text")).join(merged(nameless), F.col(MARK) == F.col("kept fp"), "left_semi").dropDuplicates([MARK])
        kept = kept.unionAll(marked.select(own))
    return kept.toDF(*docs.columns)


#: Column that holds the fingerprint beside a table's own columns, which are numbered here.
MARK = "fingerprint"


def _fingerprinted(rows: DataFrame, text: int) -> DataFrame:
    """``rows`` with the column MARK, for the few rows that have no doc_id to join by, or one that repeats. ``text``: the place of their text."""
    schema = T.StructType([*rows.schema.fields, T.StructField(MARK, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(MARK, pa.array([fingerprint(x) for x in batch.column(text).to_pylist()], pa.int64()))

    return rows.mapInArrow(run, schema)
