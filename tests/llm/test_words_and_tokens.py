"""Classifier, collocations and alignment against brute force, the libraries and held-out rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fissure.llm import alignment, automaton, collocations, subwords
from fissure.llm.bpe import byte_symbols

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# 11


def junk_or_not(n: int, seed: int):
    """Labelled texts: junk repeats words or ends them in symbols."""
    r, parts, rows = random.Random(seed), ["th", "er", "on", "an", "re", "in", "ed", "tion"], []
    for i in range(n):
        words = ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(r.randint(5, 80))]
        good = int(r.random() < 0.7)
        if not good:
            words = [w for w in words for _ in range(2)] if i % 2 else [w + r.choice(["%%%", "###", "$$$"]) for w in words]
        rows.append((i, " ".join(words), good))
    return rows


def test_subwords(spark, docs, empty):
    rows = junk_or_not(400, 1)
    texts = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    # labels of the held-out fold are all wrong: they must not be looked at
    labels = spark.createDataFrame([(i, 1 - good if zlib.crc32(str(i).encode()) % 5 == 0 else good) for i, _, good in rows], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in subwords.scores(texts, labels, steps=8000).collect()}
    assert len(got) == 400 and all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    held = [(got[i]["predicted"], good) for i, _, good in rows if got[i]["held_out"]]
    assert sum(p == g for p, g in held) >= 0.97 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    again = {r["doc_id"]: r["score"] for r in subwords.scores(texts.repartition(3), labels.repartition(2), steps=8000).collect()}
    assert all(again[i] == pytest.approx(r["score"], abs=1e-9) for i, r in got.items())
    odd = labels.unionAll(spark.createDataFrame([(None, 1), (3, None), (4, 7), (99999, 0)], "doc_id long, quality int"))
    everything = subwords.scores(docs, odd, steps=500).collect()
    assert len(everything) == docs.count() and all(0 <= r["score"] <= 1 for r in everything)
    assert all(r["held_out"] is False for r in everything if r["doc_id"] is None)
    assert subwords.scores(empty, labels).count() == 0
    assert {r["score"] for r in subwords.scores(docs, labels.limit(0)).collect()} == {0.5}


def test_subwords_score_is_the_softmax_of_the_average(spark):
    rows = junk_or_not(30, 2)
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] for r in rows], pa.int32()), pa.array(range(30), pa.int64()), pa.array([r[1] for r in rows])], names=["good", "turn", "text"])
    found = subwords.features(batch)
    model = subwords.Model()
    at, share = (found.column(c).flatten().to_numpy() for c in ("at", "share"))
    ends = np.cumsum(found.column("at").value_lengths().to_numpy())
    assert [x.sum() for x in np.split(share, ends[:-1])] == pytest.approx([1] * 30)
    worth, bias = model.train(at, share, ends, np.array([r[2] for r in rows]), 300, 0.5).worth()
    for a, s in zip(np.split(at, ends[:-1]), np.split(share, ends[:-1]), strict=True):
        z = model.outputs @ (s @ model.vectors[a]) + model.bias
        assert 1 / (1 + np.exp(-(worth[a] @ s + bias))) == pytest.approx(np.exp(z[1]) / np.exp(z).sum(), abs=1e-5)


def test_subword_places():
    at, owner = subwords.places(pa.array(["ab", "é"], pa.large_string()))
    # <ab>: two of 3, one of 4; <é>: one of 3; and the words themselves
    assert Counter(owner.tolist()) == {0: 4, 1: 2} and len(set(at.tolist())) == 6


def test_subwords_bounds(spark):
    rows = junk_or_not(300, 3)
    texts, labels = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, quality int")
    assert subwords.labelled(texts, labels, 50).count() < 80
    worth, _ = subwords.train(texts, labels, sample=20, entries=3000, steps=100)
    assert np.isfinite(worth).all()


# 12


def test_automaton():
    r = random.Random(1)
    for _ in range(150):
        depth = r.randint(1, 4)
        pieces = [[r.randint(0, 2) for _ in range(r.randint(1, 8))] for _ in range(r.randint(0, 5))]
        words = np.array([x for p in pieces for x in p], np.int64)
        found = automaton.build(words, np.repeat(np.arange(len(pieces)), [len(p) for p in pieces]).astype(np.int64), depth)
        ends, at = defaultdict(set), 0
        for p in pieces:
            for e in range(len(p)):
                for k in range(1, min(depth, e + 1) + 1):
                    ends[tuple(p[e - k + 1 : e + 1])].add(at + e)
            at += len(p)
        state = {}
        for k in range(1, depth + 1):
            for s, e in zip(*(x.tolist() for x in found.substrings(k)), strict=True):
                phrase = tuple(words[e - k + 1 : e + 1].tolist())
                assert phrase not in state and found.at[k - 1][e] == s
                state[phrase] = s
        assert set(state) == set(ends)
        for t, s in state.items():
            assert found.count[s] == len(ends[t])
            assert all((s == v) == (ends[t] == ends[u]) for u, v in state.items())
            longest = max((u for u in state if state[u] == s), key=len)
            further = [longest[i:] for i in range(1, len(longest)) if ends[longest[i:]] != ends[longest]]
            assert found.length[s] == len(longest) and found.link[s] == (state[further[0]] if further else -1)


@pytest.mark.parametrize("top", [1, 5, 1 << 20, 1 << 62])
def test_grouped(top):
    draws = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        key = draws.integers(0, top, n)
        first, inverse, count = automaton.grouped(key)
        for got, wanted in zip((first, inverse, count), np.unique(key, return_index=True, return_inverse=True, return_counts=True)[1:], strict=True):
            assert (got == wanted).all()


@pytest.mark.parametrize("least", [1, 10, 300, 70_000])
def test_places_of_a_block(least):
    """Four bytes, two for each place, a bit for each that is met again and its number: less than the steps were, and nothing is compressed."""
    draws = np.random.default_rng(4)
    for n in (0, 1, 7, 5000, 1 << collocations.BLOCK):
        at = np.sort(draws.permutation(1 << collocations.BLOCK)[:n])
        times = np.minimum(draws.integers(1, 100_000, n), least)
        data = collocations._packed(at, times, least)
        assert len(data) == 4 + 2 * n + -(-n // 8) + int((times > 1).sum()) * np.min_scalar_type(least).itemsize
        for got, wanted in zip(collocations._unpacked(data, n, least), (at, times), strict=True):
            assert (got == wanted).all()


def test_words_of_a_shard():
    rows = [("en", "One two,THREE  ÀB\x00c\tfour\x0bfive"), ("de", None), (None, ""), ("en", "."), ("de", "one"), ("en", "x"), ("en", "y one;")]
    shard = collocations.Shard(pa.table({"lang": pa.array([r[0] for r in rows], pa.string()), "text": pa.array([r[1] for r in rows], pa.string())}), 3)
    got = [(shard.langs[shard.lang[w]], shard.texts[w].as_py()) for w in shard.words.tolist()]
    pieces = [(lang, re.findall(r"[^ \t]+", p.translate(LOWER))) for lang, text in rows for p in re.split(r"[.,;:!?\n-\r]", text or "")]
    assert got == [(lang, w) for lang, p in pieces for w in p]
    assert np.diff(np.flatnonzero(np.diff(shard.piece, prepend=-1)), append=len(got)).tolist() == [len(p) for _, p in pieces if p]
    assert len(set(shard.hash.tolist())) == len(set(got))


def brute_collocations(rows, longest, least, top, share):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(words)
            f.update((lang or "und", tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    frequent = {key: a for key, a in f.items() if a >= least}
    out = defaultdict(list)
    for (lang, w), a in frequent.items():
        inside = any(l2 == lang and len(v) > len(w) and 100 * b >= share * a and any(v[i : i + len(w)] == w for i in range(len(v))) for (l2, v), b in frequent.items())
        if len(w) > 1 and not inside:
            cuts = [(10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return Counter((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


@pytest.mark.parametrize(("longest", "least", "top", "bits", "shard"), [(3, 10, 2000, 27, 8 << 20), (3, 3, 20, 27, 500), (4, 4, 2000, 17, 2000), (2, 2, 50, 18, 300)])
def test_collocations(spark, monkeypatch, longest, least, top, bits, shard):
    monkeypatch.setattr(collocations, "BITS", bits)
    monkeypatch.setattr(collocations, "SHARD", shard)
    r = random.Random(9)
    words = ["the", "Of", "new", "york", "CITY", "é", "É", "a\x1cb", "x y", "und", "z"]
    weights = [9, 7, 6, 6, 5, 1, 1, 1, 1, 2, 1]
    rows = [(r.choice(["en", "en", "de", None, "und"]), "".join(r.choices(words, weights)[0] + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\x0b"]) for _ in range(r.randint(0, 60)))) for _ in range(120)]
    rows += [("en", None), (None, None), ("fr", ""), ("es", "new york " * 700), ("de", "new york, the of. " * 900), ("es", "new york"), rows[0], rows[0]]
    docs = spark.createDataFrame([(*x, 1, "q", 3) for x in rows], "lang string, text string, a long, phrase string, size int").repartition(4)
    got = of(collocations.mine(docs, longest, least, top), "lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert got == brute_collocations(rows, longest, least, top, 50)


def test_collocation_scores(spark):
    r = random.Random(1)
    rows = [(r.randint(1, min(x, y)), x, y) for _ in range(500) for x, y in [(r.randint(1, 10 ** r.randint(1, 15)), r.randint(1, 10 ** r.randint(1, 15)))]]
    rows += [(a, a, a) for a in (1, 10**14, 10**15 - 1)] + [(10**15 - 2, 10**15 - 1, 10**15 - 1)]
    for x in spark.createDataFrame([x for x in rows if x[0] < 10**15], "a long, l long, r long").select("*", collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect():
        assert x.s == 10**6 * x.a * x.a // (x.l * x.r)


def test_collocations_of_nothing(spark, empty, docs):
    assert collocations.mine(empty).count() == 0
    assert collocations.mine(docs).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


# 13


def brute_alignment(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte, per, held = {c: b for b, c in enumerate(byte_symbols())}, [], Counter()
    for i, text in rows:
        groups = []
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
            first = [bytes(byte[c] for c in t.id_to_token(k)) for k in a]
            second = [bytes([int(s.id_to_piece(k)[3:5], 16)]) if s.is_byte(k) else s.id_to_piece(k).replace("▁", " ").encode() for k in b]
            if b"".join(first) == b"".join(second) == (" " + text).encode():
                ends = [np.cumsum([len(x) for x in side]).tolist() for side in (first, second)]
                at = (0, 0)
                places = [{e: k + 1 for k, e in enumerate(side)} for side in ends]
                for e in sorted(set(ends[0]) & set(ends[1])):
                    to = (places[0][e], places[1][e])
                    groups.append((a[at[0] : to[0]], b[at[1] : to[1]]))
                    at = to
        per.append((i, groups))
        held.update({(p, q) for x, y in groups for p in x for q in y})
    best = defaultdict(int)
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    for i, groups in per:
        links = [(p, q) for x, y in groups for p in x for q in y]
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        yield (i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if groups else "")


@pytest.mark.parametrize("shard", [8 << 20, 300])
def test_alignment(spark, rows, monkeypatch, shard):
    monkeypatch.setattr(alignment, "SHARD", shard)
    r = random.Random(3)
    parts = [" ", "  ", "\n", " \n", "\t", " ", "　", " ", " ", "\x1c", "\x85", " ", "a", "the", "Qu", "1", "23", ".", "é", "à", "é", "'s", "<|endoftext|>", "<s>", "<0x41>", "ß", "日本", "\U0001f600", "\0", "%%%", "﻿", "​", "ation", "Ƞ"]
    texts = [(i, "".join(r.choice([*parts, "▁"] if i % 9 == 0 else parts) for _ in range(r.randint(0, 25)))) for i in range(1500)]
    texts += [(x[0], x[1]) for x in rows] + [(None, "a b"), (7, None), (8, ""), (9, " "), (10, "  "), (11, " " * 5000), (12, "\n" * 6000), (13, "x" * 20000), (14, "a" + " " * 70001 + "b"), (15, "= " * 3000)]
    docs = spark.createDataFrame([(*x, 1, 2, "q") for x in texts], "doc_id long, text string, n long, code long, shard string").repartition(5)
    got = of(alignment.align(docs), *(x.split()[0] for x in alignment.OUT.split(", ")))
    assert got == Counter(brute_alignment(texts))


def test_transducer():
    t = alignment.Transducer({0: b" ab", 1: b"c", 2: b"x"}, {0: b" ", 1: b"a", 2: b"bc", 3: b"y"})
    assert t.groups([0, 1], [0, 1, 2]) == [(2, 3)]
    assert t.groups([1, 0, 1], [2]) is None and t.groups([2], [3]) is None and t.groups([0], [0, 1]) is None
    steps = sum(map(len, t.next))
    assert t.groups([0, 1, 0, 1], [0, 1, 2, 0, 1, 2]) == [(2, 3), (4, 6)] and sum(map(len, t.next)) == steps


def test_long_texts_align(spark):
    texts = [(1, " " * 1_000_000), (2, "ab" * 500_000), (3, "word " * 200_000), (4, "\n" * 1_000_000)]
    rows = {r["doc_id"]: r for r in alignment.align(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert all(rows[i]["n_groups"] > 0 for i in (1, 2, 3, 4)) and rows[3]["n_a"] >= 200_000


def test_alignment_of_nothing(spark, empty):
    assert alignment.align(empty).count() == 0
