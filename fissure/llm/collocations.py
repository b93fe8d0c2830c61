"""Phrase collocation mining with generalised suffix automata.

Every shard of about SHARD bytes of text gets the suffix automaton of its pieces, bounded in depth, whose states enumerate the phrases of up to ``longest`` words with the number of places where they end. Counts are
added up over shards in three rounds. The first adds up places in a bitmap of BITS bits to which phrases below the longest are hashed, in order to tell which may be frequent; the bitmap goes to the tasks, and its size is the same for every corpus. The second does so for
the longest phrases whose parts are in it. The third counts the words themselves, of the phrases that are in the bitmaps. A place that several phrases share, or a bitmap that is full, only makes the third round count phrases that turn out rare.

A phrase of the longest kind is only looked at if its suffix link, the phrase without its first word, and the state that its last word leads from, the phrase without that, are in the bitmap. The same two are what a phrase
may subsume; no phrase longer still is more frequent.

Null texts are empty, a null ``lang`` is ``und``. Repeated rows count as often as they stand there. Extra columns are ignored. All numbers are exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fissure.llm._common import release, slices, table, utf8
from fissure.llm.automaton import Automaton, build, grouped

#: Bytes of text of a shard. A longer document is cut between pieces, which no phrase crosses; a longer piece is a shard of its own.
SHARD = 2 << 20
BITS = 27
#: Places of the bitmap that one row of its table holds.
BLOCK = 17
HALF = 1 << 16
SEPARATOR = re.compile(r"[.,;:!?\n-\r]")
#: By byte: does it end a piece, is it between words, and its lower case.
SPLITS, BLANK = np.zeros(256, bool), np.zeros(256, bool)
SPLITS[list(b".,;:!?\n\x0b\x0c\r")] = True
BLANK[list(b" \t")] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
POWER = np.uint64(0x9FB21C651E98DF25)
ODD = np.random.default_rng(7).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Parts of a language's phrases that are ranked apart before they are ranked together.
PARTS = 256


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A polynomial of each word's bytes modulo 2^64, mixed. Words that share one share places of a bitmap, which costs time only."""
    data, offsets = utf8(words)
    if not len(words):
        return np.zeros(0, np.uint64)
    size = np.diff(offsets)
    power = np.full(int(size.max()), POWER)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    at = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    return _mixed(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[at], offsets[:-1]))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Shard:
    """Words of some documents as numbers, and the automaton over them. The same word in two languages has two numbers."""

    def __init__(self, batch: pa.Table, longest: int):
        data, offsets = utf8(batch.column("text").combine_chunks())
        data = LOWER[data]
        lang = pc.fill_null(batch.column("lang"), "und").combine_chunks().dictionary_encode()
        self.langs = lang.dictionary.to_pylist()
        inside = ~(SPLITS | BLANK)[data]
        # a word begins after a blank, a mark or the end of a text
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        begins[edges] = inside[edges]
        starts = np.flatnonzero(begins)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        self.piece = np.cumsum(SPLITS[data])[starts] + doc
        # the bytes of words alone, and where each begins
        packed = data[inside]
        at = np.append(np.cumsum(inside)[starts] - 1, len(packed)).astype(np.int64)
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(packed)).dictionary_encode()
        k = max(len(self.langs), 1)
        number = coded.indices.to_numpy().astype(np.int64) * k + lang.indices.to_numpy().astype(np.int64)[doc]
        first, self.words, _ = grouped(number)
        distinct = number[first]
        self.texts, self.lang = coded.dictionary.take(pa.array(distinct // k)), distinct % k
        seeds = np.fromiter((xxhash.xxh64_intdigest(x) for x in self.langs), np.uint64, len(self.langs))
        self.hash = _word_hashes(self.texts) + seeds[self.lang]
        self.automaton: Automaton = build(self.words, self.piece, longest)

    def hashes(self, depth: int, ends: np.ndarray) -> np.ndarray:
        """A hash of the ``depth`` words that end at each place."""
        out = np.full(len(ends), depth, np.uint64)
        for k in range(depth):
            out += self.hash[self.words[ends - k]] * ODD[k]
        return _mixed(out)

    def phrases(self, depth: int, ends: np.ndarray) -> pa.Array:
        parts = [self.texts.take(pa.array(self.words[ends - k])) for k in reversed(range(depth))]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())).cast(pa.string())


def _divided(part: pa.RecordBatch):
    """A document of more than SHARD bytes in parts of about SHARD characters that end with a piece; anything else as it is."""
    text = part.column("text")[0].as_py() if part.num_rows == 1 else None
    if text is None or len(text) <= SHARD:
        yield part
        return
    at = 0
    while at < len(text):
        mark = SEPARATOR.search(text, at + SHARD)
        end = mark.end() if mark else len(text)
        yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([text[at:end]])], names=["lang", "text"])
        at = end


def _over_shards(rows, longest: int):
    """``rows`` of each shard of a partition, a batch at a time."""

    def run(batches):
        size, rest = 0, []
        try:
            for part in chain.from_iterable(map(_divided, slices(batches))):
                more = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if rest and size + more > SHARD:
                    yield from rows(Shard(pa.Table.from_batches(rest), longest))
                    size, rest = 0, []
                    release()
                rest.append(part)
                size += more
            if rest:
                yield from rows(Shard(pa.Table.from_batches(rest), longest))
        finally:
            release()

    return run


def counted_bits(texts: DataFrame, least: int, depths: range, held=None) -> np.ndarray:
    """A bitmap over the first BITS bits of hashes: all phrases of ``depths`` words that occur ``least`` times are in it, and few others. Its size is fixed.

    A task sends, for each block of places of the bitmap, the places that its shards' phrases have, sorted, and how often; these are added up block by block. ``held(shard, depth, ends)`` leaves out what can't be frequent.
    """

    def rows(shard: Shard):
        for depth in depths:
            states, ends = shard.automaton.substrings(depth)
            if held is not None:
                keep = held(shard, depth, ends)
                states, ends = states[keep], ends[keep]
            place = (shard.hashes(depth, ends) >> np.uint64(64 - BITS)).astype(np.int64)
            # place and count in one number; beyond ``least`` it doesn't matter how often
            pairs = np.sort(place << 31 | np.minimum(shard.automaton.count[states], least))
            first = np.flatnonzero(np.diff(pairs >> 31, prepend=-1))
            place = pairs[first] >> 31
            n = np.minimum(np.add.reduceat(pairs & ((1 << 31) - 1), first), least) if len(first) else first
            block = place >> BLOCK
            edges = np.flatnonzero(np.diff(block, prepend=-1))
            inside = (place & ((1 << BLOCK) - 1)).astype(np.int32)
            parts = [(int(block[a]), _packed(inside[a:z], n[a:z], least), z - a) for a, z in zip(edges.tolist(), [*edges[1:].tolist(), len(block)], strict=True)]
            for i in range(0, len(parts), 256):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*parts[i : i + 256], strict=True), (pa.int32(), pa.binary(), pa.int64()), strict=True)], names=["block", "data", "n"])

    found = texts.mapInArrow(_over_shards(rows, max(depths)), "block int, data binary, n long").withColumn("salt", F.spark_partition_id().cast("int") / F.lit(64))
    # the parts of up to 64 tasks, then what is left of those
    merged = found.withColumn("salt", F.col("salt").cast("int")).groupBy("block", "salt").applyInArrow(_merged(least), "block int, data binary, n long").groupBy("block").applyInArrow(_merged(least), "block int, data binary, n long")

    def bits(batches):
        for batch in batches:
            out = []
            for data, n in zip(batch.column("data").to_pylist(), batch.column("n").to_pylist(), strict=True):
                at, times = _unpacked(data, n, least)
                flags = np.zeros(1 << BLOCK, bool)
                flags[at[times >= least]] = True
                out.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], names=["block", "bits"])

    out = np.zeros((1 << (BITS - BLOCK), 1 << (BLOCK - 3)), np.uint8)
    got = merged.mapInArrow(bits, "block int, bits binary").toArrow()
    for block, flags in zip(got.column("block").to_pylist(), got.column("bits").to_pylist(), strict=True):
        out[block] = np.frombuffer(flags, np.uint8)
    return out.ravel()


def _packed(at: np.ndarray, times: np.ndarray, least: int) -> bytes:
    """Sorted places of a block, and how often each is met: how many lie in its first half, two bytes a place, a bit for what is met again, and how often that is (``least`` at most)."""
    again = times > 1
    return b"".join(x.tobytes() for x in (np.searchsorted(at, HALF).astype(np.int32), at.astype(np.uint16), np.packbits(again), times[again].astype(np.min_scalar_type(least))))


def _unpacked(data: bytes, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(data, np.uint16, n, 4).astype(np.int64)
    at[np.frombuffer(data, np.int32, 1)[0] :] += HALF
    bits = -(-n // 8)
    again = np.unpackbits(np.frombuffer(data, np.uint8, bits, 4 + 2 * n), count=n).astype(bool)
    times = np.ones(n, np.int64)
    times[again] = np.frombuffer(data[4 + 2 * n + bits :], np.min_scalar_type(least))
    return at, times


def _merged(least: int):
    """Adds up the parts of one block, a batch at a time; beyond ``least`` it doesn't matter how often."""

    def run(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BLOCK, np.int64)
        for batch in parts:
            for data, n in zip(batch.column("data").to_pylist(), batch.column("n").to_pylist(), strict=True):
                at, times = _unpacked(data, n, least)
                total[at] += times
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([_packed(at, np.minimum(total[at], least), least)], pa.binary()), pa.array([len(at)], pa.int64())], names=["block", "data", "n"])

    return run


def _in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes >> np.uint64(65 - (len(bits) * 8).bit_length())
    return (bits[h >> np.uint64(3)] >> (np.uint64(7) - (h & np.uint64(7))).astype(np.uint8) & 1).astype(bool)


def frequent(texts: DataFrame, longest: int, least: int) -> DataFrame:
    """``(lang, size, phrase, a)`` of all phrases of up to ``longest`` words that occur ``least`` times, and a row of size 0 per language that counts its words."""
    sent = texts.sparkSession.sparkContext.broadcast
    # written to the executors once; the size does not depend on the data
    shorter = sent(counted_bits(texts, least, range(1, longest)))

    def possible(shard: Shard, depth: int, ends: np.ndarray) -> np.ndarray:
        """Are the phrase without its first word, its suffix link, and the one without its last word, which leads to it, in the bitmap?"""
        return _in(shorter.value, shard.hashes(depth - 1, ends)) & _in(shorter.value, shard.hashes(depth - 1, ends - 1))

    full = sent(counted_bits(texts, least, range(longest, longest + 1), possible)) if longest > 1 else shorter

    def rows(shard: Shard):
        automaton = shard.automaton
        langs = pa.array(shard.langs, pa.string())

        def batch(depth: int, lang: np.ndarray, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([langs.take(pa.array(lang)), pa.array(np.full(len(n), depth, np.int32)), phrase, pa.array(n)], names=["lang", "size", "phrase", "a"])

        total = np.bincount(shard.lang[shard.words], minlength=len(langs)) if len(shard.words) else np.zeros(len(langs), np.int64)
        yield batch(0, np.arange(len(langs)), pa.array([""] * len(langs), pa.string()), total.astype(np.int64))
        known = None
        for depth in range(1, longest + 1):
            states, ends = automaton.substrings(depth)
            held = _in((shorter if depth < longest else full).value, shard.hashes(depth, ends))
            if known is not None:
                # the suffix link's side and the side that the last word is added to
                held &= known[automaton.at[depth - 2][ends]] & known[automaton.at[depth - 2][ends - 1]]
            if depth < longest:
                # by state: of its substrings, the one of this depth
                known = np.zeros(len(automaton.count), bool)
                known[states[held]] = True
            states, ends = states[held], ends[held]
            for i in range(0, len(ends), 1 << 16):
                e = ends[i : i + (1 << 16)]
                yield batch(depth, shard.lang[shard.words[e]], shard.phrases(depth, e), automaton.count[states[i : i + (1 << 16)]])

    counted = texts.mapInArrow(_over_shards(rows, longest), "lang string, size int, phrase string, a long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a")).filter(F.expr(f"size = 0 or a >= {least}"))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) of integers with a <= left, right; exact, as long as a is below 10^15."""
    wide = lambda x, digits: x.cast(f"decimal({digits},0)")
    top, below = wide(wide(a, 15) * wide(a, 15) * F.lit(1000000).cast("decimal(7,0)"), 38), wide(wide(left, 19) * wide(right, 19), 38)
    return ((top - top % below) / below).cast("long")


def mine(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, share: int = 50) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of 2 to ``longest`` words of each language of ``docs(lang, text)`` that occur ``least`` times.

    The score is that of the weakest cut. Phrases inside a longer one with at least ``share`` percent of their occurrences are left out.
    """
    texts = docs.select(F.col("`lang`").alias("lang"), F.col("`text`").alias("text"))
    counts = table(frequent(texts, longest, least))
    phrases = counts.filter("size > 1")
    words = F.split("phrase", " ")
    held = F.array(F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " "))
    longer = phrases.filter("size > 2").select("lang", F.explode(held).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").filter(f"longer is null or 100 * cast(longer as decimal(38,0)) < {share} * cast(a as decimal(38,0))").select("lang", "size", "phrase", "a")
    parts = kept.select("*", F.split("phrase", " ").alias("w")).select("lang", "phrase", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k"), "w")
    sides = parts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail"))
    known = counts.filter("size > 0")
    # both sides are tables that are shuffled, so a word that begins very many phrases is split
    sides = sides.join(known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"]).join(known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    cut = sides.select("lang", "phrase", "a", F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = cut.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part"))
    first = scored.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("place") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    # a row for each language
    total = counts.filter("size = 0").select("lang", F.col("a").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
