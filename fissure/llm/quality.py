"""Quality rules: gradient-boosted trees over document statistics, after two fixed rules.

Statistics of every whole text are computed once and written to the checkpoint folder; the trees are fitted on labelled rows of that
table (at most ``sample``, the first by a hash of doc_id) and score all of it as numpy node arrays. More symbols, more repeated
lines and more repeated words never raise a score. The cut is the highest score that keeps ``keep_share`` of the labelled good
documents of a held-out fifth, but at most even odds, so that clean documents stay.

Null texts count as empty: they have no words and fail the base rule. Without usable labels of both classes the base rules decide alone.
Several labels of one document count as bad if one is bad; labels with nulls are ignored. Repeated rows give repeated results; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fissure.llm._common import CONTINUATION, SPACE, cut, map_text, merged, pick, plain_words, sums, utf8
from fissure.llm.gbt import Trees, fit

MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
MIX = 0x9E3779B97F4A7C15
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_chars_all", "n_upper", "n_digit", "n_marks", "n_accented", "n_distinct", "n_bare"]
FEATURES = ["size", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "accented", "distinct", "bare", "line_words"]
MONOTONE = [0, 0, -1, -1, -1, 0, 0, 0, 0, 0, 0, 0]


def _table(*bytes_: int) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(bytes_)] = True
    return flags


SYMBOL, UPPER, DIGIT = _table(*SYMBOLS), _table(*range(65, 91)), _table(*range(48, 58))
MARK = _table(*b"!\"'(),-./:;?@[]^_`{}~+=\\")


def _repeats(words: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Words of each document that lie in a window of WINDOW words found twice or more in it."""
    k = len(words) - WINDOW + 1
    if k <= 0:
        return np.zeros(n, np.int64)
    at = np.flatnonzero(doc[:k] == doc[WINDOW - 1 :])
    key = doc[at].astype(np.uint64)
    for i in range(WINDOW):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(MIX) + words[at + i].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    a, b = at[order[same]], at[order[same + 1]]
    if not all(np.array_equal(x, y) for x, y in ((doc[a], doc[b]), *((words[a + i], words[b + i]) for i in range(WINDOW)))):
        # two different windows share a hash: number the windows by their words instead
        rows = np.stack([doc[at], *(words[at + i] for i in range(WINDOW))], axis=1)
        _, key = np.unique(rows, axis=0, return_inverse=True)
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
        a, b = at[order[same]], at[order[same + 1]]
    edge = np.zeros(len(words) + 1, np.int64)
    twice = np.union1d(a, b)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n)


def _dup_lines(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of their document, and all lines with a word."""
    split = pc.split_pattern(pc.fill_null(column, "").cast(pa.large_string()), "\n")
    doc = np.repeat(np.arange(n), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    flat = split.flatten()
    full = pc.greater(pc.binary_length(pc.ascii_trim(flat, " \t\n\r\x0b\x0c")), 0)
    doc = doc[full.to_numpy(zero_copy_only=False)].astype(np.int64)
    ids = flat.filter(full).dictionary_encode().indices.to_numpy().astype(np.int64)
    lines = np.bincount(doc, minlength=n)
    distinct = np.bincount(np.unique(doc * (len(ids) + 1) + ids) // (len(ids) + 1), minlength=n)
    return lines - distinct, lines


def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
    column, n = batch.column("text"), batch.num_rows
    data, offsets = utf8(column)
    starts = ~CONTINUATION[data]
    flat, doc = plain_words(column)
    ids = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    words = np.bincount(doc, minlength=n)
    dup, lines = _dup_lines(column, n)
    distinct = np.bincount(np.unique(doc.astype(np.int64) * (len(ids) + 1) + ids) // (len(ids) + 1), minlength=n)
    letters = (data >= 128) | UPPER[data] | ((data >= 97) & (data <= 122)) | DIGIT[data]
    ends = pc.binary_length(flat).to_numpy(zero_copy_only=False)
    packed = letters[~SPACE[data]]
    bare = sums(packed, np.concatenate([[0], np.cumsum(ends)])) == 0 if len(ids) else np.zeros(0, bool)
    values = [words, sums(starts & ~SPACE[data], offsets), sums(SYMBOL[data], offsets), dup, _repeats(ids, doc, n), lines, sums(starts, offsets)]
    values += [sums(x[data], offsets) for x in (UPPER, DIGIT, MARK)] + [sums(starts & (data >= 128), offsets), distinct, np.bincount(doc[bare], minlength=n)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, pa.int64()) for v in values)], names=["doc_id", *COUNTS, *MORE])


def statistics(docs: DataFrame) -> DataFrame:
    return map_text(pick(docs, "doc_id", "text"), kernel, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS + MORE))


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_chars_all"], 1), np.maximum(c["n_lines"], 1)
    columns = [np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words]
    columns += [c[x] / chars for x in ("n_upper", "n_digit", "n_marks", "n_accented")]
    return np.stack([*columns, c["n_distinct"] / words, c["n_bare"] / words, np.log1p(words / lines)], axis=1).astype(float)


def train(stats: DataFrame, labels: DataFrame, sample: int = 20_000, keep_share: float = 0.999) -> tuple[Trees, float] | None:
    """Trees and the least score that is kept, from at most ``sample`` labelled rows; None without rows of both classes."""
    known = labels.select("doc_id", F.col("quality").alias("good")).filter("doc_id is not null and good in (0, 1)").groupBy("doc_id").agg(F.min("good").alias("good"))
    labelled = cut(stats.join(merged(known), "doc_id").withColumn("turn", F.expr("pmod(xxhash64(doc_id), 1000000)")))
    n = labelled.count()
    # a part that holds about, and in the end at most, ``sample`` rows
    part = labelled.filter(F.col("turn") < int(1_020_000 * sample / n)) if n > sample else labelled
    rows = part.toPandas().sort_values(["turn", "doc_id", *COUNTS], ignore_index=True)[:sample]
    if rows["good"].nunique() < 2:
        return None
    x, y = features({c: rows[c].to_numpy() for c in COUNTS + MORE}), rows["good"].to_numpy().astype(float)
    held = np.arange(len(y)) % 5 == 4
    if not (y[held] == 1).any() or len(set(y[~held])) < 2:
        held[:] = False
    trees = fit(x[~held], y[~held], MONOTONE)
    check = trees.score(x[held] if held.any() else x)
    good = np.sort(check[(y[held] if held.any() else y) == 1])
    return trees, float(min(0.0, good[int((1 - keep_share) * len(good))]))


def verdicts(docs: DataFrame, labels: DataFrame, sample: int = 20_000, keep_share: float = 0.999) -> DataFrame:
    """``(doc_id, counts, base_failed, score, kept)`` for every row of ``docs(doc_id, text)``; ``labels(doc_id, quality)``."""
    stats = cut(statistics(docs))
    model = train(stats, labels, sample, keep_share)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))

    def score(batches):
        for batch in batches:
            counts = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS + MORE}
            got = model[0].score(features(counts)) if model else np.zeros(batch.num_rows)
            yield batch.append_column("score", pa.array(got, pa.float64()))

    scored = stats.mapInArrow(score, T.StructType([*stats.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.select("doc_id", *COUNTS, *MORE, failed.alias("base_failed"), "score", (~failed & (F.col("score") >= (model[1] if model else 0.0))).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = 20_000, keep_share: float = 0.999) -> DataFrame:
    """``docs`` without the rows that are rejected.

    Statistics and scores are computed beside the rows in a second pass, so that rows are kept one by one whatever their doc_id, and no text is shuffled.
    """
    model = train(cut(statistics(docs)), labels, sample, keep_share)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = kernel(pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column("text")], names=["doc_id", "text"]))
        counts = {c: stats.column(c).to_numpy(zero_copy_only=False) for c in COUNTS + MORE}
        kept = (counts["n_words"] >= MIN_WORDS) & (100 * counts["n_repeat_words"] <= MAX_REPEAT_PERCENT * counts["n_words"])
        if model:
            kept &= model[0].score(features(counts)) >= model[1]
        return batch.filter(pa.array(kept))

    return map_text(docs, keep, docs.schema)
