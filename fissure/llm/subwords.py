"""Quality classifier: supervised subword embeddings.

Every word, and every run of GRAMS characters of it between its marks of begin and end, has a vector of DIM numbers in one of 2^BITS hashed places. A document is the average of the vectors of all its words and their runs; two softmax outputs over it
are trained together with the vectors by stochastic gradient descent, in numpy. Words that equal the one before them, lines that equal the one before, and the end of a document are words of their own, so that an empty text has one.

The mean and the outputs are linear, so after training each place is worth one number, its vector's share in the difference of the two outputs: scoring adds these up, over whole texts, without a shuffle.

Learning sees labelled rows whose ``crc32(doc_id) mod 5`` is not 0, at most ``sample`` of them by a hash, and at most ``entries`` numbers in all; of several labels of one document the lower counts, and labels with nulls are ignored. Neither
labels nor language, source and id are inputs of a score. Without labels of both classes the score is the share of good ones, or one half. Null texts are empty. Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fissure.llm._common import map_text, pick, plain_words, table

BITS, DIM = 18, 16
GRAMS = (3, 4, 5)
FOLDS = 5
CUT = 0.3
ODD = np.random.default_rng(3).integers(0, 1 << 63, max(GRAMS) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
END, AGAIN, LINE_AGAIN = (np.uint64(xxhash.xxh64_intdigest(x)) for x in ("end of document", "word again", "line again"))


def _place(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(64 - BITS)).astype(np.int64)


def places(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words and their runs of characters, and the word of each."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    listed = words.to_pylist()
    whole = _place(np.fromiter(map(xxhash.xxh64_intdigest, listed), np.uint64, n))
    marked = pc.binary_join_element_wise(*(x if isinstance(x, pa.Array) else pa.scalar(x, pa.large_string()) for x in ("<", words, ">", "")))
    letters = np.frombuffer("".join(marked.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    of = np.repeat(np.arange(n), pc.utf8_length(marked).to_numpy())
    out, owner = [whole], [np.arange(n)]
    for k in GRAMS:
        if len(letters) < k:
            break
        inside = np.flatnonzero(of[: len(of) - k + 1] == of[k - 1 :])
        h = np.full(len(inside), k, np.uint64) * ODD[-1]
        for i in range(k):
            h += letters[inside + i] * ODD[i]
        out.append(_place(h))
        owner.append(of[inside])
    return np.concatenate(out), np.concatenate(owner)


def _repeated_lines(column: pa.Array) -> np.ndarray:
    """Lines with a word that equal the one before, by document."""
    split = pc.split_pattern(pc.fill_null(column, "").cast(pa.large_string()), "\n")
    doc = np.repeat(np.arange(len(column)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    flat = pc.ascii_trim(split.flatten(), " \t\r\x0b\x0c")
    full = pc.greater(pc.binary_length(flat), 0)
    doc, line = doc[full.to_numpy(zero_copy_only=False)], flat.filter(full).dictionary_encode().indices.to_numpy()
    same = np.flatnonzero((line[1:] == line[:-1]) & (doc[1:] == doc[:-1])) + 1
    return np.bincount(doc[same], minlength=len(column))


def words_of(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, list[tuple[np.uint64, np.ndarray]]]:
    """Distinct words, the number and document of each word, and how often each document has the words that stand for repeats and its end."""
    n = batch.num_rows
    flat, doc = plain_words(batch.column("text"))
    coded = flat.dictionary_encode()
    number = coded.indices.to_numpy().astype(np.int64)
    again = np.flatnonzero((number[1:] == number[:-1]) & (doc[1:] == doc[:-1])) + 1
    marks = [(END, np.ones(n, np.int64)), (AGAIN, np.bincount(doc[again], minlength=n)), (LINE_AGAIN, _repeated_lines(batch.column("text")))]
    return coded.dictionary, number, doc, marks


def features(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Distinct places of every document, and their shares of its average."""
    n = batch.num_rows
    words, number, doc, marks = words_of(batch)
    at, owner = places(words)
    order = np.argsort(owner, kind="stable")
    at, size = at[order], np.bincount(owner, minlength=len(words))
    start = np.cumsum(size) - size
    key, times = np.unique(doc * max(len(words), 1) + number, return_counts=True)
    held, word = key // max(len(words), 1), key % max(len(words), 1)
    row = np.repeat(np.arange(len(key)), size[word] if len(words) else 0)
    within = np.arange(len(row)) - np.repeat(np.cumsum(size[word]) - size[word], size[word]) if len(row) else row
    docs = [held[row], *(np.flatnonzero(x) for _, x in marks)]
    spots = [at[start[word[row]] + within] if len(row) else row, *(np.full(np.count_nonzero(x), _place(np.array([h]))[0]) for h, x in marks)]
    counts = [times[row], *(x[x > 0] for _, x in marks)]
    key, inverse = np.unique(np.concatenate(docs).astype(np.int64) << BITS | np.concatenate(spots).astype(np.int64), return_inverse=True)
    weight = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(key))
    of = key >> BITS
    weight /= np.bincount(of, weights=weight, minlength=n)[of]
    ends = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in ((key & (1 << BITS) - 1).astype(np.int32), weight.astype(np.float32))]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("good", "turn")), *lists], names=["good", "turn", "at", "share"])


class Model:
    """Vectors of all places and the outputs of two classes."""

    def __init__(self, seed: int = 1):
        self.r = np.random.default_rng(seed)
        self.vectors = self.r.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
        self.outputs = np.zeros((2, DIM), np.float32)
        self.bias = np.zeros(2, np.float32)

    def step(self, at: np.ndarray, share: np.ndarray, good: int, rate: float) -> None:
        """One document: softmax over its average, gradients to the outputs and to the vectors of its places."""
        rows = self.vectors[at]
        mean = share @ rows
        z = self.outputs @ mean + self.bias
        error = np.exp(z - z.max())
        error /= error.sum()
        error[good] -= 1
        back = error @ self.outputs
        self.outputs -= rate * error[:, None] * mean
        self.bias -= rate * 0.1 * error
        # a document's places differ from each other, so none is written twice
        self.vectors[at] = rows - (rate * share)[:, None] * back

    def train(self, at: np.ndarray, share: np.ndarray, ends: np.ndarray, good: np.ndarray, steps: int, rate: float) -> Model:
        rounds = -(-steps // len(good))
        starts, total = np.concatenate([[0], ends[:-1]]), rounds * len(good)
        for i in range(rounds):
            for k, d in enumerate(self.r.permutation(len(good)).tolist()):
                here = slice(starts[d], ends[d])
                self.step(at[here], share[here], int(good[d]), rate * (1 - (i * len(good) + k) / total))
        return self

    def worth(self) -> tuple[np.ndarray, float]:
        """What each place adds to the logit of the good class if a document consisted of it alone, and what every document has."""
        return self.vectors @ (self.outputs[1] - self.outputs[0]), float(self.bias[1] - self.bias[0])


def remainder(doc_id: Column) -> Column:
    """crc32 of an id as text, modulo FOLDS; -1 for null."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % FOLDS, F.lit(-1))


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``(good, turn, at, share)`` of about ``sample`` labelled rows, but all if there are fewer; equal rows count once."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("good")).filter("doc_id is not null and good in (0, 1)").filter(remainder(F.col("doc_id")) > 0)
    known = table(known.groupBy("doc_id").agg(F.min("good").alias("good")).withColumn("turn", F.expr("pmod(xxhash64(doc_id), 1000000)")))
    n = known.count()
    # at most ``sample`` and a few, so it may be sent to all tasks, and no text without a label is moved
    part = known.filter(F.col("turn") < int(1_000_000 * sample / n)) if n > sample else known
    rows = pick(docs, "doc_id", "text").join(F.broadcast(part), "doc_id").withColumn("key", F.xxhash64("text"))
    once = rows.groupBy("doc_id", "key", "good", "turn").agg(F.first("text").alias("text")).withColumn("turn", F.expr("pmod(xxhash64(doc_id, key), 1000000)"))
    return table(map_text(once.select("good", "turn", "text"), features, "good int, turn long, at array<int>, share array<float>"))


def train(docs: DataFrame, labels: DataFrame, sample: int = 6000, entries: int = 12_000_000, steps: int = 30_000, rate: float = 1.0) -> tuple[np.ndarray, float]:
    """What each place is worth, and the bias, from at most ``sample`` labelled rows and ``entries`` numbers. All rows are gone over until ``steps`` are made."""
    rows = labelled(docs, labels, sample)
    n, size, good = rows.agg(F.count("*"), F.sum(F.size("at")), F.sum("good")).first()
    if not n or good in (0, n):
        return np.zeros(1 << BITS, np.float32), float(np.log((good + 0.5) / (n - good + 0.5))) if n else 0.0
    part = min(1.0, sample / n, entries / size)
    got = (rows.filter(F.col("turn") < int(1_000_000 * part)) if part < 1 else rows).toArrow()
    # the order of rows is theirs, not that of the tasks
    first = [x[0] if len(x) else -1 for x in (row.values.to_numpy() for row in got.column("at"))]
    order = np.lexsort((first, pc.list_value_length(got.column("at")).to_numpy(), got.column("turn").to_numpy()))
    got = got.take(pa.array(order[:sample])).combine_chunks()
    at, share = (got.column(c).combine_chunks().flatten().to_numpy() for c in ("at", "share"))
    ends = np.cumsum(pc.list_value_length(got.column("at")).to_numpy())
    return Model().train(at, share, ends, got.column("good").to_numpy(), steps, rate).worth()


def scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs(doc_id, text)``; ``labels(doc_id, quality)``."""
    worth, bias = train(docs, labels, **options)
    # 2^BITS numbers, whatever the data
    sent = docs.sparkSession.sparkContext.broadcast((worth.astype(np.float64), bias))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, constant = sent.value
        n = batch.num_rows
        words, number, doc, marks = words_of(batch)
        at, owner = places(words)
        total, size = np.bincount(owner, weights=value[at], minlength=len(words)), np.bincount(owner, minlength=len(words))
        added, count = np.bincount(doc, weights=total[number], minlength=n), np.bincount(doc, weights=size[number], minlength=n)
        for h, times in marks:
            added += value[_place(np.array([h]))[0]] * times
            count += times
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-(added / count + constant))))], names=["doc_id", "score"])

    found = map_text(pick(docs, "doc_id", "text"), kernel, "doc_id long, score double")
    return found.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
