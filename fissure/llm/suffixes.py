"""Suffix-array dedup with sparse suffixes.

Suffixes are retained where a document's content selects them: at the smallest hash of GRAM words among any SPAN neighbouring positions. Two documents
that share a passage of MIN_WORDS words therefore retain the same suffix within its first SPAN words. Retained suffixes are sorted by (the hash of) their
first CORE = MIN_WORDS - SPAN + 1 words; those that stand alone, or only with suffixes of the same text, are dropped. A suffix is then extended by up to SPAN - 1 words
to the left and the rest to the right: for each such reach, neighbours in the order of the extended suffixes are compared, and equal ones of different texts are matches. The union of the matches of a document is exactly
the set of its words that lie in a passage of MIN_WORDS words found in another document; what repeats only inside one document is not reported. Equal texts are compared once; a text of MIN_WORDS words or more that several
documents hold is a repeated passage as a whole.

Groups of up to GROUP suffixes with one core are sorted and compared in the task that holds them, of which a task sees one batch at a time. The extended suffixes of a larger group are
grouped by their hashes, which spreads over tasks and gives the same matches.

Null and empty texts have no words and no passages. Rows that share doc_id and text are one document. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fissure.llm._common import map_text, pick, plain_words, table

MIN_WORDS, GRAM, SPAN = 50, 8, 16
CORE = MIN_WORDS - SPAN + 1
GROUP = 256
ODD = np.random.default_rng(2024).integers(0, 1 << 63, MIN_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts in a row, and the document of each."""
    flat, doc = plain_words(column)
    coded = flat.dictionary_encode()
    digest = xxhash.xxh64_intdigest
    table_ = np.fromiter((digest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return (table_[coded.indices.to_numpy()] if len(table_) else np.zeros(0, np.uint64)), doc


def _grams(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for i in range(length):
        out += words[at + i] * ODD[i]
    return _mixed(out)


def anchors(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Positions of retained suffixes that hold CORE words of their document."""
    n = len(words) - GRAM + 1
    if n < SPAN:
        return np.zeros(0, np.int64)
    grams = _grams(words, np.arange(n), GRAM)
    windows = np.lib.stride_tricks.sliding_window_view(grams, SPAN)
    chosen = []
    for a in range(0, len(windows), 1 << 18):
        part = windows[a : a + (1 << 18)]
        start = np.arange(a, a + len(part))
        ok = doc[start] == doc[start + SPAN + GRAM - 2]
        chosen.append(np.unique(start[ok] + part[ok].argmin(1)))
    at = np.unique(np.concatenate(chosen))
    at = at[at + CORE <= len(words)]
    return at[doc[at] == doc[at + CORE - 1]]


def _starts(doc: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(doc, np.arange(n + 1))


def retained(docs: DataFrame) -> DataFrame:
    """``(key, dkey, doc_id, n_words, pos)``: hash of the first CORE words, text, document and word position of each retained suffix."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, doc = word_hashes(batch.column("text"))
        at = anchors(words, doc)
        start = _starts(doc, batch.num_rows)
        of = doc[at] if len(at) else at
        take = pa.array(of, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(_grams(words, at, CORE).view(np.int64), pa.int64()), batch.column("dkey").take(take), batch.column("doc_id").take(take), pa.array(np.diff(start)[of], pa.int32()), pa.array(at - start[of], pa.int32())], names=["key", "dkey", "doc_id", "n_words", "pos"])

    return map_text(docs.select("dkey", "doc_id", "text"), kernel, "key long, dkey long, doc_id long, n_words int, pos int")


def contexts(docs: DataFrame) -> DataFrame:
    """The words on both sides of the suffixes at ``docs(dkey, least, text, places)``: short hashes outward from the core, 0 past an end of the text."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, doc = word_hashes(batch.column("text"))
        short = (words >> np.uint64(33)).astype(np.int32) | np.int32(1)
        start = _starts(doc, batch.num_rows)
        places = batch.column("places")
        of = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy(zero_copy_only=False))
        flat = places.flatten()
        pos = flat.field("pos").to_numpy(zero_copy_only=False).astype(np.int64)
        at = pos + start[of]
        reach = np.arange(1, SPAN)
        side = []
        for where in (at[:, None] - reach, at[:, None] + CORE - 1 + reach):
            inside = (where >= start[of][:, None]) & (where < start[of + 1][:, None])
            side.append(np.where(inside, short[np.clip(where, 0, max(0, len(words) - 1))], 0) if len(words) else np.zeros(where.shape, np.int32))
        left, right = (pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.int32).ravel()), SPAN - 1).cast(pa.list_(pa.int32())) for x in side)
        return pa.RecordBatch.from_arrays([flat.field("key"), batch.column("dkey").take(pa.array(of)), batch.column("least").take(pa.array(of)), pa.array(pos, pa.int32()), left, right], names=["key", "dkey", "least", "pos", "l", "r"])

    return map_text(docs.select("dkey", "least", "text", "places"), kernel, "key long, dkey long, least long, pos int, l array<int>, r array<int>")


def _sides(batch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, SPAN - 1) for c in ("l", "r"))


def _passages(batch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the SPAN passages of MIN_WORDS words that hold each suffix's core, the one that reaches ``j`` words to its left in column ``j``; which of them lie in the text."""
    reach = np.arange(SPAN)
    parts, whole = [], []
    for side, odd in zip(_sides(batch), (ODD[: SPAN - 1], ODD[SPAN : 2 * SPAN - 1]), strict=True):
        total = np.zeros((len(side), SPAN), np.uint64)
        np.cumsum(side.astype(np.uint64) * odd, axis=1, out=total[:, 1:])
        parts.append(total)
        whole.append(np.concatenate([np.ones((len(side), 1), bool), np.logical_and.accumulate(side != 0, axis=1)], axis=1))
    key = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
    return _mixed(_mixed(key[:, None] + reach.astype(np.uint64) * ODD[-1]) ^ (parts[0] + parts[1][:, ::-1])), whole[0] & whole[1][:, ::-1]


def _neighbours(part: pa.RecordBatch) -> pa.RecordBatch:
    """The span of each suffix that another text's suffix shares a passage with. ``part`` holds whole groups.

    For each reach to the left the suffixes are sorted by the passage, so that equal ones are neighbours. All passages of a suffix hold its core, so those found unite to one span.
    """
    h, whole = _passages(part)
    dkey, pos = (part.column(c).to_numpy(zero_copy_only=False) for c in ("dkey", "pos"))
    n = len(dkey)
    least, most, of = np.full(n, SPAN), np.full(n, -1), np.full(n, -1)
    for j in range(SPAN):
        rows = np.flatnonzero(whole[:, j])
        rows = rows[np.lexsort((dkey[rows], h[rows, j]))]
        run = np.concatenate([[0], np.flatnonzero(np.diff(h[rows, j].view(np.int64))) + 1]) if len(rows) else np.zeros(0, np.int64)
        size = np.diff(np.append(run, len(rows)))
        first, last = rows[run], rows[run + size - 1]
        several = np.repeat(dkey[first] != dkey[last], size)
        hit, one, two = rows[several], np.repeat(first, size)[several], np.repeat(last, size)[several]
        least[hit], most[hit] = np.minimum(least[hit], j), j
        of[hit] = np.where(dkey[one] == dkey[hit], two, one)
    hit = np.flatnonzero(most >= 0)
    return pa.RecordBatch.from_arrays([pa.array(dkey[hit]), pa.array(pos[hit] - most[hit], pa.int32()), pa.array(pos[hit] + MIN_WORDS - least[hit], pa.int32()), part.column("least").take(pa.array(of[hit]))], names=["dkey", "start", "end", "other"])


def _compare(batches):
    """``_neighbours`` of sorted rows, as many groups at a time as a batch completes; only the last group waits for the next batch."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.diff(key)) + 1
        if rest and rest[-1].column("key")[-1].as_py() != key[0]:
            yield from map(_neighbours, _joined(rest))
            rest = []
        if len(edges):
            yield from map(_neighbours, _joined([*rest, batch.slice(0, edges[-1])]))
            rest, batch = [], batch.slice(edges[-1])
        rest.append(batch)
    if rest:
        yield from map(_neighbours, _joined(rest))


def _joined(parts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()


def _windows(batches):
    """Passages around each suffix, with their starts."""
    for batch in batches:
        h, whole = _passages(batch)
        row, j = np.nonzero(whole)
        take = pa.array(row)
        pos = batch.column("pos").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(h[row, j].view(np.int64)), batch.column("dkey").take(take), batch.column("least").take(take), pa.array(pos[row] - j, pa.int32())], names=["h", "dkey", "least", "start"])


def _merged(batches):
    """One row per document: its spans united."""
    for batch in batches:
        spans, words = [], []
        for row in batch.column("spans").to_pylist():
            out: list[list[int]] = []
            for x in sorted((s["start"], s["end"]) for s in row):
                if out and x[0] <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], x[1])
                else:
                    out.append(list(x))
            spans.append(",".join(f"{a}-{b}" for a, b in out))
            words.append(sum(b - a for a, b in out))
        yield pa.RecordBatch.from_arrays([batch.column("dkey"), pa.array(words, pa.int64()), pa.array(spans, pa.string()), batch.column("other")], names=["dkey", "dup_words", "spans", "other"])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``(doc_id, dup_words, spans, shared_with)`` for the documents of ``docs(doc_id, text)`` that share a passage with another one.

    ``spans``: word positions start-end, end exclusive, comma-joined; ``shared_with``: a doc_id that it was found to share one with.
    """
    keyed = pick(docs, "doc_id", "text").withColumn("dkey", F.xxhash64("text"))
    suffixes = table(retained(keyed))
    holders = suffixes.groupBy("dkey", "doc_id").agg(F.max("n_words").alias("n_words"))
    texts = table(holders.groupBy("dkey").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("copies"), F.max("n_words").alias("n_words"), F.min(F.struct("doc_id")).alias("holder")))
    # written, so that the join below shuffles both sides and Spark can split a key that many rows have
    shared = table(suffixes.groupBy("key").agg(F.min("dkey").alias("low"), F.max("dkey").alias("high")).filter("low <> high").select("key"))
    places = suffixes.join(shared, "key").groupBy("dkey").agg(F.collect_set(F.struct("pos", "key")).alias("places")).join(texts.select("dkey", "least", "holder.doc_id"), "dkey")
    asked = keyed.join(places.withColumnRenamed("doc_id", "holder_id"), "dkey").filter("doc_id <=> holder_id")
    around = table(contexts(asked))
    hot = table(around.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP).select("key"))
    few = around.join(hot, "key", "left_anti").repartition("key").sortWithinPartitions("key").mapInArrow(_compare, "dkey long, start int, end int, other long")
    many = around.join(hot, "key", "left_semi").mapInArrow(_windows, "h long, dkey long, least long, start int")
    twice = table(many.groupBy("h").agg(F.min("dkey").alias("low"), F.max("dkey").alias("high"), F.min("least").alias("a"), F.max("least").alias("b")).filter("low <> high").select("h", "a", "b"))
    spread = many.join(twice, "h").select("dkey", "start", (F.col("start") + MIN_WORDS).alias("end"), F.expr("if(a <=> least, b, a)").alias("other"))
    whole = texts.filter(f"copies > 1 and n_words >= {MIN_WORDS}").select("dkey", F.lit(0).alias("start"), F.col("n_words").alias("end"), F.lit(None).cast("long").alias("other"))
    spans = few.unionAll(spread).unionAll(whole).groupBy("dkey").agg(F.collect_set(F.struct("start", "end")).alias("spans"), F.min("other").alias("other"))
    merged = table(spans.mapInArrow(_merged, "dkey long, dup_words long, spans string, other long").join(texts.select("dkey", "least", "most"), "dkey"))
    copy = F.expr("nullif(if(doc_id <=> least, most, least), doc_id)")
    return holders.select("dkey", "doc_id").join(merged, "dkey").select("doc_id", "dup_words", "spans", F.least(copy, "other").alias("shared_with"))
