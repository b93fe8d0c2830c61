"""Each operator against a brute-force version, on awkward rows and on empty tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fissure.llm import bpe, components, gbt, licenses, mixing, quality, secrets, sharding, simhash, suffixes, token_counts, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# 1


def test_token_counts(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    for rule in token_counts.RULES:
        got = defaultdict(list)
        for r in token_counts.section_token_counts(docs, rule).collect():
            got[r["doc_id"]].append((r["section"], r["start_char"], r["end_char"], r["n_tokens"], r["doc_tokens"]))
        for row in rows:
            if row[0] is None or row[0] in (5, 12):
                continue
            text = row[1] or ""
            n = len(t.encode(text, add_special_tokens=False).ids)
            parts = sorted(got[row[0]])
            assert sum(p[3] for p in parts) == pytest.approx(n) and all(p[4] == n for p in parts)
            assert "".join(text[a:b] for _, a, b, _, _ in parts) == text
            assert [text[a:b] for _, a, b, _, _ in parts] == (text.split("\n") and [x for x in re.split(r"(?<=\n)", text) if x] or [""])


def test_long_white_space(spark, monkeypatch):
    import random

    encoding, _ = token_counts.encoder(token_counts.default_vocabulary())
    monkeypatch.setattr(token_counts, "RUN", re.compile(token_counts.RUN.pattern.replace("4096", "3")))
    r = random.Random(4)
    for _ in range(2000):
        text = "".join(r.choice([" ", "  ", "   ", "\n", "\n\n\n", "\t", "\u3000", "\x1c", "\x85", "ab", "1", ".", "é", "'s"]) for _ in range(r.randint(0, 20)))
        assert token_counts.encode(encoding, text).tolist() == encoding.encode_ordinary(text)
    monkeypatch.undo()
    data = [(1, "a" + " " * 1_000_001 + "b"), (2, "\n" * 1_000_000), (3, " \t" * 600_000 + "x"), (4, "a b")]
    got = defaultdict(float)
    for x in token_counts.section_token_counts(spark.createDataFrame(data, "doc_id long, text string")).groupBy("doc_id").agg(F.sum("n_tokens"), F.max("doc_tokens"), F.max("end_char")).collect():
        assert x[1] == pytest.approx(x[2]) and x[3] == len(dict(data)[x[0]])
        got[x[0]] = x[1]
    assert got[4] == 2 and got[2] == pytest.approx(len(encoding._encode_single_piece("\n" * 1_000_000)))


def test_crossing_tokens():
    ends, cuts = np.array([2, 5, 9, 10]), np.array([4, 6, 10])
    assert token_counts.attribute(ends, cuts, "start")[0].tolist() == [2, 1, 1]
    assert token_counts.attribute(ends, cuts, "majority")[0].tolist() == [2, 0, 2]
    assert token_counts.attribute(ends, cuts, "split")[0].tolist() == pytest.approx([1 + 2 / 3, 1 / 3 + 1 / 4, 3 / 4 + 1])
    assert token_counts.attribute(ends, cuts, "start")[1].tolist() == [1, 1, 0]


# 2


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_simhash(docs, rows):
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    root = linked({f for _, f in fps})
    least = {}
    for i, f in fps:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    assert of(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == Counter((i, f"{f:016x}", least.get(root[f])) for i, f in fps)


@pytest.mark.parametrize(("bucket", "crowd"), [(0, 2048), (0, 1), (0, -1), (4, 8), (64, 2048)])
def test_simhash_links(spark, bucket, crowd, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "CROWD", crowd)
    r = np.random.default_rng(1)
    centers = r.integers(0, 1 << 63, 6, dtype=np.uint64)
    values = {int(c) ^ sum(1 << int(b) for b in r.choice(64, r.integers(0, 5), replace=False)) for c in centers for _ in range(60)}
    values |= {0, 1, (1 << 64) - 1, 0x80000001 << 31}
    fps = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    found = components.connected_components(simhash.links(fps)).collect()
    groups = defaultdict(set)
    for x in found:
        groups[x["root"]].add(x["node"] % (1 << 64))
    want = defaultdict(set)
    for v, root in linked(values).items():
        want[root].add(v)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in want.values() if len(g) > 1}


def test_keep_one(docs, rows):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    fps = {brute_fingerprint(r[1]) for r in rows}
    assert kept.count() == len(set(linked(fps).values()))


def test_keep_one_with_names_of_its_own(spark):
    names = ["kept_id", "kept_fp", "twice_id", "simhash fingerprint", "fingerprint", "fp", "root", "id", "component_id", "kept id", "kept fp", "repeated id", "least", "node", "doc.id", "0", "1"]
    a, b = (" ".join(f"{k}{i * i % 97}" for i in range(60)) for k in "ab")
    data = [(str(i), text, id_, *([i] * (len(names) - 1))) for i, (id_, text) in enumerate([(1, a), (2, a), (3, b), (3, a), (None, b), (5, b), (3, b), (None, "x y z"), (None, "x y z")])]
    docs = spark.createDataFrame(data, ", ".join(["`0` string", "text string", "doc_id long", *(f"`{n}` long" for n in names if n != "0")]))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.schema.simpleString() == docs.schema.simpleString()
    assert of(kept, "doc_id", "text") == Counter([(1, a), (3, b), (None, "x y z")])


def test_keep_one_of_ids_with_several_texts(spark):
    a, b, c = (" ".join(f"{k}{i * i % 97}" for i in range(60)) for k in "abc")
    data = [(1, a), (1, b), (1, b), (2, a), (0, c), (3, c), (1, c), (4, b)]
    kept = simhash.keep_one(spark.createDataFrame(data, "doc_id long, text string").repartition(3))
    assert of(kept, "doc_id", "text") == Counter([(1, a), (1, b), (0, c)])


def test_components_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99), (5, 5)], "a long, b long")
    assert of(components.connected_components(links), "node", "root") == Counter([(i, 0) for i in range(61)] + [(99, 99), (100, 99)])


# 3


def test_topk(spark):
    r = np.random.default_rng(2)
    v = r.normal(0, 1, (700, 8)).astype("float32")
    v[100:300] = v[100]
    data = [(i, x.tolist(), "e") for i, x in enumerate(v)] + [(700, None, "e"), (701, [None] + [0.5] * 7, "e"), (750, [float("nan")] * 8, "e"), (None, [0.1] * 8, "e"), (703, [], "e"), (704, [1.0, 2.0], "e"), (3, v[3].tolist(), "e")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score string")
    data += [(50, v[7].tolist(), "e"), (50, (v[7] * 2).tolist(), "e"), (50, v[50].tolist(), "e")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score string")
    # every row by itself, also those that share a vec_id
    whole = [(i, np.floor(256 * np.array(x, float))) for i, x, _ in data if i is not None and x is not None and all(y is not None and math.isfinite(y) for y in x)]
    whole = [(i, np.pad(x, (0, 8 - len(x)))) for i, x in whole]
    want = Counter()
    for at, (q, x) in enumerate(whole):
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for other, (i, y) in enumerate(whole) if other != at)[:5]
            want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(best))
    for ring, block, queries in ((512, 8192, 4096), (40, 32, 5)):
        topk.RING, topk.BLOCK, topk.QUERIES = ring, block, queries
        assert of(topk.top_k(df, F.expr("vec_id % 50 = 0")), "query_id", "rank", "vec_id", "score") == want
    topk.RING, topk.BLOCK, topk.QUERIES = 512, 8192, 4096
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert set(of(topk.top_k(few, F.expr("vec_id % 50 = 0")), "query_id", "rank", "vec_id", "score")) == {(0, 1, 1, 256 * 512)}
    twice = spark.createDataFrame([(7, [2.0, 0.0]), (7, [3.0, 0.0]), (0, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert of(topk.top_k(twice, F.expr("vec_id % 50 = 0")), "query_id", "rank", "vec_id", "score") == Counter([(0, 1, 7, 3 * 65536), (0, 2, 7, 2 * 65536)])
    assert topk.top_k(few.limit(0), F.expr("vec_id % 50 = 0")).count() == 0


@pytest.mark.parametrize("magnitude", [1e3, 1e5, 5e5])
def test_topk_of_large_numbers(spark, magnitude, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "RING", 64)
    r = np.random.default_rng(3)
    v = (r.normal(0, magnitude, (1500, 16)) + magnitude * r.integers(0, 3, (1500, 1))).astype("float32")
    whole = np.floor(256 * v.astype(float)).astype(np.int64)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    want = set()
    for q in range(0, 1500, 5):
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:5]
        want |= {(q, k + 1, int(i), int(scores[i])) for k, i in enumerate(order)}
    assert set(of(topk.top_k(df, F.expr("vec_id % 5 = 0")), "query_id", "rank", "vec_id", "score")) == want


# 4


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality(spark, docs, rows):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0, "x") for i in range(20, 70)] + [(None, 1, 0, "x"), (30, None, None, "x"), (31, 0, 0, "x")], "doc_id long, quality int, toxic int, text string")
    got = of(quality.verdicts(docs, labels), "doc_id", *quality.COUNTS, "base_failed")
    want = Counter()
    for r in rows:
        c = brute_counts(r[1])
        want[(r[0], *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
    assert got == want
    assert not quality.verdicts(docs, labels).filter("kept and base_failed").count()
    for none in (labels.limit(0), labels.filter("quality = 1")):
        assert quality.verdicts(docs, none).filter("kept = base_failed").count() == 0
    kept = quality.keep_good(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if not k[-1])


def test_repeats_with_hash_collisions(monkeypatch):
    words, doc = np.array([1, 2, 3, 4, 5] * 3 + [9, 8, 7, 6, 5, 4, 5]), np.repeat([0, 1], [15, 7])
    want = quality._repeats(words, doc, 2).tolist()
    monkeypatch.setattr(quality, "MIX", 0)  # windows with the same last word now share a hash
    assert quality._repeats(words, doc, 2).tolist() == want == [15, 0]


def test_gbt_is_monotone_and_learns():
    r = np.random.default_rng(0)
    x = r.uniform(0, 1, (4000, 3))
    y = (r.uniform(0, 1, 4000) < 1 / (1 + np.exp(-(4 * x[:, 0] - 3 * x[:, 1])))).astype(float)
    trees = gbt.fit(x[:3000], y[:3000], [1, -1, 0])
    p = trees.score(x[3000:]) > 0
    assert (p == (y[3000:] == 1)).mean() > 0.68
    base = r.uniform(0, 1, (200, 3))
    for f, sign in ((0, 1), (1, -1)):
        grid = np.repeat(base, 21, 0)
        grid[:, f] = np.tile(np.linspace(0, 1, 21), 200)
        assert (sign * np.diff(trees.score(grid).reshape(200, 21), axis=1) >= -1e-12).all()


# 5


def test_licenses(docs, rows):
    got = {}
    for r in licenses.scan(docs).collect():
        got[r["doc_id"]] = r
    for r in rows:
        if r[0] is None:
            continue
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r[1] or "").translate(LOWER))
        at = {label: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p, label in licenses.BASE.items()}
        every = sorted(i for x in at.values() for i in x)
        g = got[r[0]]
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"]) == (len(words), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(k for k, x in at.items() if x)))
        assert 0 <= g["score"] <= 1 and set(filter(None, g["base_labels"].split(","))) <= set(g["labels"].split(","))
    assert got[14]["labels"] == "mit,reserved" and got[15]["labels"] == "cc-by,gpl,gpl-3" and got[20]["labels"] == ""


def test_licenses_by_index_against_all_starts():
    r = np.random.default_rng(9)
    weight = r.uniform(0.5, 8, len(licenses.VOCABULARY))
    names = sorted(licenses.VOCABULARY)
    for cover in (0.6, 0.8, 0.95):
        index = licenses.build(weight, cover)
        found = 0
        for _ in range(60):
            t = int(r.integers(len(licenses.TEMPLATES)))
            words = list(licenses.TEMPLATES[t][1])
            for _ in range(int(r.integers(0, 1 + len(words) // 6))):
                k = int(r.integers(len(words)))
                words[k : k + 1] = [[], ["zzz"], [words[k], "zzz"]][int(r.integers(3))]
            text = " ".join([*r.choice(names, 20), *words, *r.choice(names, 20)])
            ids = licenses.licence_words(text)
            possible, certain = set(), set()
            for u, (label, _, _) in enumerate(licenses.TEMPLATES):
                notice, heavy = licenses.NOTICES[u], weight[licenses.NOTICES[u]]
                where = [licenses.places(ids, k) for k in licenses.KEYS[u]]
                if not all(map(len, where)):
                    continue
                n, rare = len(notice), index.position[index.template == u]
                for start in range(-n, len(ids)):
                    near = [any(0 <= start + i + d < len(ids) and ids[start + i + d] == notice[i] for d in range(-2, 3)) for i in range(n)]
                    if heavy[near].sum() / heavy.sum() >= cover and all(any(start - 2 <= p <= start + n + 2 for p in found_) for found_ in where):
                        possible.add(label)
                        if any(0 <= start + i < len(ids) and ids[start + i] == notice[i] for i in rare.tolist()):
                            certain.add(label)
            got, _ = licenses.match(ids, index, cover)
            assert certain <= got <= possible
            found += licenses.TEMPLATES[t][0] in got
        assert found > 30


@pytest.mark.parametrize(("tag", "labels"), [
    ("MIT", "mit"), ("MIT-0", "mit-0"), ("BSD-2-Clause-Patent */", "bsd-2-clause-patent"), ("BSD-2-Clause", "bsd-2-clause"), ("MIT OR Apache-2.0", "apache-2.0,mit"), ("GPL-2.0", "gpl-2"), ("GPL-2.0+ */", "gpl-2"), ("gpl-3.0-or-later -->", "gpl-3"), ("LGPL-2.1-only", "lgpl"),
    ("(GPL-2.0-only WITH Linux-syscall-note) AND MIT\nint a;", "gpl-2,mit"), ("((MIT)) or ISC", "isc,mit"), ("Apache-2.0 WITH LLVM-exception", "apache-2.0"), ("LicenseRef-own-1", "licenseref-own-1"), ("see the file", ""), ("TODO", ""), ("<id>", ""), ("MIT OR", ""), ("CC0-1.0", "cc0"),
])
def test_license_expressions(tag, labels):
    assert ",".join(sorted(licenses.expression_labels(f"// SPDX-License-Identifier: {tag}\nmore text"))) == labels


def test_whole_licenses(spark):
    data = [(1, "Copyright 2020 Jane Roe\n\n" + licenses.TEXTS[2][1])]
    data += [(2, "# " + licenses.TEXTS[5][1].replace("\n", "\n# ")), (3, "/* SPDX-License-Identifier: GPL-2.0-or-later */ int a;"), (4, "// SPDX-License-Identifier: BSD-3-Clause"), (5, "the license of the software is granted to any person")]
    data += [(6, "Copyright. " + " ".join(t[1] for t in licenses.TEXTS if t[0] in ("bsd", "bsd-2-clause", "bsd-3-clause"))), (7, next(t[1] for t in licenses.TEXTS if t[0] == "zlib")), (8, licenses.TEXTS[9][1] + " see the licenses"), (9, "mit license apache license gnu spdx"), (10, "# SPDX-License-Identifier: MIT-0 OR GPL-2.0+\n"), (11, "the words spdx license identifier alone: MIT")]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: "mit", 2: "apache-2.0", 3: "gpl-2", 4: "bsd-3-clause", 5: "", 6: "bsd,bsd-2-clause,bsd-3-clause", 7: "zlib", 8: "gpl,gpl-3", 9: "", 10: "gpl-2,mit-0", 11: ""}


# 6


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_sharding(docs, rows, shards):
    got = sharding.shard(docs, shards).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], len((r[1] or "").encode()) + 1, None if r[1] is None else zlib.crc32(r[1].encode())) for r in rows)
    assert Counter((g["doc_id"], g["size"], g["text_crc32"]) for g in got) == want
    by, sums, place = defaultdict(list), defaultdict(int), {}
    for g in got:
        by[g["shard"]].append(g["slot"])
        sums[g["sha"]] += g["size"]
        assert place.setdefault(g["sha"], g["shard"]) == g["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(shards))


def test_least_capacity():
    r = np.random.default_rng(3)
    for _ in range(200):
        sizes = r.integers(1, 50, r.integers(1, 40)).tolist()
        k = int(r.integers(1, 8))
        edges = [0, *np.cumsum(sizes).tolist()]

        def need(c, sizes=sizes):
            n, a = 1, 0
            for x in sizes:
                n, a = (n + 1, x) if a + x > c else (n, a + x)
            return n

        want = next(c for c in range(max(sizes), sum(sizes) + 1) if need(c) <= k)
        got, cuts = sharding.least_capacity(edges, [True] * len(sizes), k)
        assert got == want and all(b - a <= got for a, b in zip([0, *cuts], [*cuts, edges[-1]], strict=True))


def test_minimax_over_digests(spark):
    r = np.random.default_rng(4)
    sizes = {hashlib.sha256(str(i).encode()).hexdigest(): int(r.integers(1, 1000)) for i in range(3000)}
    old = sharding.FIRST
    for first in (1, 4):
        sharding.FIRST = first
        keys = sharding.cut_keys(spark.createDataFrame(list(sizes.items()), "sha string, size long"), 7)
        order = sorted(sizes)
        sums = Counter()
        for s in order:
            sums[sum(s >= k for k in keys)] += sizes[s]
        edges = [0, *np.cumsum([sizes[s] for s in order]).tolist()]
        assert max(sums.values()) == sharding.least_capacity(edges, [True] * len(order), 7)[0]
    sharding.FIRST = old


# 7


@pytest.mark.parametrize("group", [2, 256])
def test_suffixes(docs, rows, group):
    suffixes.GROUP = group
    texts = {(r[0], r[1]) for r in rows if r[1] is not None}
    where = defaultdict(set)
    for d in texts:
        words = WORD.findall(d[1])
        for i in range(len(words) - 49):
            where[tuple(words[i : i + 50])].add(d)
    want = Counter()
    for d in texts:
        words = WORD.findall(d[1])
        covered = {j for i in range(len(words) - 49) if len(where[tuple(words[i : i + 50])]) > 1 for j in range(i, i + 50)}
        if covered:
            want[(d[0], len(covered))] += 1
    got = suffixes.repeated_passages(docs).collect()
    suffixes.GROUP = 256
    assert Counter((g["doc_id"], g["dup_words"]) for g in got) == want
    assert {9, 10} <= {g["doc_id"] for g in got} and next(g["shared_with"] for g in got if g["doc_id"] == 9) == 10


def suffix_batches(key, dkey, left, right, size):
    import pyarrow as pa

    side = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.int32).ravel()), suffixes.SPAN - 1).cast(pa.list_(pa.int32()))
    whole = pa.RecordBatch.from_arrays([pa.array(key), pa.array(dkey), pa.array(dkey), pa.array(np.full(len(key), 20), pa.int32()), side(left), side(right)], names=["key", "dkey", "least", "pos", "l", "r"])
    return [whole.slice(i, size) for i in range(0, len(key), size)]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_neighbours_of_sorted_suffixes(size):
    r = np.random.default_rng(8)
    key, n = np.sort(r.integers(0, 30, 300)), suffixes.SPAN - 1
    dkey = r.integers(0, 150, 300)
    left, right = (np.where(np.arange(n) < r.integers(0, n + 1, 300)[:, None], r.integers(1, 3, 300)[:, None], r.integers(0, 3, (300, 1))) for _ in range(2))
    same = lambda x, i, j: int(np.logical_and.accumulate((x[i] == x[j]) & (x[i] != 0)).sum())
    want = defaultdict(set)
    for i in range(300):
        for j in range(300):
            if key[i] == key[j] and dkey[i] != dkey[j] and same(left, i, j) + same(right, i, j) >= n:
                want[int(dkey[i])] |= set(range(20 - same(left, i, j), 20 + suffixes.CORE + same(right, i, j)))
    got = defaultdict(set)
    for batch in suffixes._compare(iter(suffix_batches(key, dkey, left, right, size))):
        for x in batch.to_pylist():
            got[x["dkey"]] |= set(range(x["start"], x["end"]))
            assert x["other"] != x["dkey"]
    assert got == want and len(want) > 20


def test_many_groups_of_suffixes_stay_small():
    import tracemalloc

    groups, members, n = 1000, 200, suffixes.SPAN - 1
    key, dkey = np.repeat(np.arange(groups), members), np.tile(np.arange(members), groups)
    batches = suffix_batches(key, dkey, np.ones((len(key), n)), np.ones((len(key), n)), 10_000)
    tracemalloc.start()
    rows = sum(b.num_rows for b in suffixes._compare(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == groups * members and peak < 64 << 20


# 8


def brute_base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16])


def test_secrets(docs, rows):
    got = {r["doc_id"]: r for r in secrets.digests(docs).collect()}
    for r in rows:
        if r[0] is None:
            continue
        spans = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in brute_base(r[1] or "")]
        g = got[r[0]]
        assert g["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [g["n_assign"], g["n_access"], g["n_hex"]] == [sum(s.startswith(k) for s in spans) for k in secrets.KINDS]
        assert set(spans) <= set(g["spans"].split(",")) | {""}
    assert got[16]["n_assign"] == 2 and got[16]["n_access"] == 1 and got[16]["n_hex"] == 1
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    out = {r["doc_id"]: r for r in clean.collect()}
    assert out[16]["text"] == "[SECRET]\" and [SECRET] password: hunter2 [SECRET]" and out[16]["n_chars"] == len(out[16]["text"]) and out[0]["text"] is None


def test_secret_corner_cases():
    for text in ("token: password: abcdefghijklmnop", "ſecret=abcdefghijklmnop", "PASSWD'='abcdefghijkl", "AKIA" + "A" * 13, "xAKIAAKIA" + "B" * 20, "éé token=aaaaaaaaaaaaaaaa deadbeefdeadbeef0"):
        assert secrets.base_spans(text) == brute_base(text)


def test_network_on_unseen_findings():
    net, (a, b), threshold = secrets.model(0.98)
    data = secrets.findings(1500, seed=99)
    p = 1 / (1 + np.exp(-(a * net.logits(np.stack([secrets.encode(t, s, e) for t, s, e, _ in data])) + b)))
    y = np.array([v for *_, v in data])
    assert (p[y == 1] >= threshold).mean() > 0.93 and (p[y == 0] >= threshold).mean() < 0.02


def test_secrets_behind_long_prefixes():
    r = np.random.default_rng(5)
    key = lambda n: "".join(r.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), n))
    prefixes = ("/some/long/path/name/of/a/service/", "PAYMENT_SERVICE_PRODUCTION_CLIENT=", "/some/long/path/name/of/a/service/" * 3)
    texts = [f"see {p}{key(40)} there" for p in prefixes for _ in range(50)]
    plain = [f"see {p}other/names/of/version2/ there" for p in prefixes]
    _, spans = secrets.find_all(texts + plain, secrets.model(0.98))
    assert np.mean([any(x["end"] == len(t) - 6 for x in row) for t, row in zip(texts, spans, strict=False)]) > 0.9
    assert not any(spans[len(texts) :])
    data = secrets.hidden(600, seed=98)
    _, spans = secrets.find_all([d[0] for d in data], secrets.model(0.98))
    assert np.mean([any(x["start"] < d[2] and d[1] < x["end"] for x in row) for d, row in zip(data, spans, strict=True) if d[3]]) > 0.93


def test_runs_beside_base_findings_and_without_digits():
    r = np.random.default_rng(6)
    key = lambda n, more="": "".join(r.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + more), n))
    beside = [f"xoxb-1234567890123456-{key(24, '0123456789')}" for _ in range(50)]
    _, spans = secrets.find_all(beside, secrets.model(0.98))
    assert all([x["kind"] for x in row if x["kind"] != "network"] == ["hex"] for row in spans)
    assert np.mean([any(x["start"] == 0 and x["end"] == len(t) for x in row) for t, row in zip(beside, spans, strict=True)]) > 0.9
    _, spans = secrets.find_all([f"key = {key(32)}" for _ in range(50)] + ["see getUserNameFromRequestHeader", "-" * 40, "/usr/share/common/licenses/apache"], secrets.model(0.98))
    assert np.mean([any(x["end"] == 38 for x in row) for row in spans[:50]]) > 0.9 and not any(spans[50:])
    assert any(not any(c.isdigit() for c in t[a:b]) for t, a, b, y in secrets.findings(400) if y)
    assert [len(x) for x in secrets.find_all(["deadbeefdeadbeef", "token=abcdefghijklmnop"], secrets.model(0.98))[1]] == [1, 1]


def test_formats_of_services():
    d = secrets.Draws(41)
    full = secrets.FULL
    planted = {
        "ghp": lambda: f"auth: Bearer ghp_{d.of(full, 36)} x", "xoxb": lambda: f"xoxb-{d.of(secrets.DIGITS, 12)}-{d.of(secrets.DIGITS, 12)}-{d.of(full, 24)}", "jwt": lambda: f"see eyJ{d.of(full, 20)}.eyJ{d.of(full, 60)}.{d.of(full + '_-', 43)} then",
        "letters": lambda: f"das ist {d.of(full[:52], 34)} und", "glpat": lambda: f"glpat-{d.of(full + '_-', 20)}", "AIza": lambda: f"url?key=AIza{d.of(full + '_-', 35)}&x=1", "SG": lambda: f"SG.{d.of(full + '_-', 22)}.{d.of(full + '_-', 43)}", "aws": lambda: f"aws_secret_access_key {d.of(full + '+/', 40)}",
    }
    for name, draw in planted.items():
        texts = [draw() for _ in range(60)]
        _, spans = secrets.find_all(texts, secrets.model(0.98))
        assert np.mean([any(x["kind"] == "network" for x in row) for row in spans]) > 0.85, name
    _, spans = secrets.find_all(["eyJhbGciOiJIUzI1NiJ9x.eyJzdWIiOiIxMjM0NTY3ODkwIn0Qk.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"], secrets.model(0.98))
    assert [(x["start"], x["end"]) for x in spans[0]] == [(0, 95)]  # one run, dots and all
    clean = [f"see getUserNameFromRequestHeader{k}" for k in range(9)] + ["https://www.example.com/articles/2019/07/how-to-write-things-1234", "mail jane.roe77@example-company.org or", "row b6d0b4fc-e0e9-4605-a048-df801e8e02d3 was", "pin Krankenversicherungsgesellschaft, the key Rechtsschutzversicherung."]
    assert not any(secrets.find_all(clean, secrets.model(0.98))[1])


def test_documents_without_secrets_are_left_alone():
    import pandas as pd

    texts = pd.read_parquet("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].fillna("").tolist()
    base, every = secrets.find_all(texts, secrets.model(0.98))
    assert sum(map(len, base)) > 30
    assert sum(any(x["kind"] == "network" for x in row) and not b for row, b in zip(every, base, strict=True)) <= len(texts) // 500


def test_candidates_beside_base_findings():
    text = "token=" + "a1" * 10 + " " + "b" * 15 + " xx.yy.zz.uu.vv.ww. pwd: short#and!odd "
    got = [text[a:b] for a, b in secrets.candidates(text, secrets.base_spans(text))]
    assert got == ["xx.yy.zz.uu.vv.ww", "short#and!odd"]
    many = " ".join(f"token={i:020d}" for i in range(3000)) + " " + " ".join(f"{i:x}zzzzzzzzzzzzzzzzz" for i in range(3000))
    assert len(secrets.candidates(many, secrets.base_spans(many))) == 3000


def test_led_values():
    """The linear walk finds what one pattern, which takes time in the square of a text's length, finds."""
    import random

    slow = re.compile(rf"""\b(?:[a-z]+[_-])*(?:{"|".join(secrets.LEADS)})[a-z_-]{{0,16}}["']?\x20*[:=\x20]\x20*["']?([^\s"'<>]{{12,}})""", re.I | re.A)
    r = random.Random(4)
    parts = ["key", "auth", "pin", "pwd", "KEY", "Login", "x", "ab", "_", "-", "_", "-", " ", "  ", ":", "=", "'", '"', "9", "é", "\n", "<", "abcdefghijkl", "abcdefghijk", "a" * 17, "1234567890123", ".", "credential", "a_", "a-", "ſ", "\u212a"]
    for _ in range(30_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 22)))
        assert secrets.led(text) == [m.span(1) for m in slow.finditer(text)], text


@pytest.mark.parametrize("text", ["key" + " " * 1_000_000, "x-" * 500_000 + "key", "key" + "x-" * 500_000, "key-" * 250_000, "a_" * 500_000 + "key: abcdefghijklmnop", "key" + "a" * 1_000_000, "key " * 250_000, "key='" * 200_000, "pin" * 300_000 + " " * 1_000_000, "key" + ":" * 1_000_000, "a" * 15 + "." * 1_000_000, "token" + " " * 1_000_000])
def test_candidates_of_long_texts(text):
    import time

    began = time.monotonic()
    secrets.candidates(text, secrets.base_spans(text))
    assert time.monotonic() - began < 10


# 9


def test_mixing(docs, rows):
    got = mixing.mix(docs).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert Counter((g["doc_id"], g["size"]) for g in got) == Counter((r[0], size(r[1])) for r in rows)
    per = defaultdict(int)
    for r in rows:
        per[r[3]] += size(r[1])
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, open_ = {}, sum(per.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * per[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 3.0 * per[s] for s in over}
        left -= sum(3 * per[s] for s in over)
        open_ -= over
    taken = defaultdict(int)
    for g in got:
        assert g["target"] == pytest.approx(target[g["source"]]) and g["source_size"] == per[g["source"]] and 0 <= g["taken"] <= 3 * g["size"]
        taken[g["source"]] += g["taken"]
    assert all(abs(taken[s] - target[s]) <= max(30, 0.02 * target[s]) for s in names)
    again = mixing.mix(docs.repartition(2)).collect()
    assert Counter((g["doc_id"], g["taken"]) for g in again) == Counter((g["doc_id"], g["taken"]) for g in got)
    out = mixing.take(docs)
    assert out.columns == docs.columns and out.count() == sum(g["copies"] for g in got)


def test_mixing_of_rows_without_ids(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 16)
    monkeypatch.setattr(mixing, "RUN", 4)
    r = np.random.default_rng(7)
    some = [(None, "w " * int(r.integers(0, 40)), f"s{i % 2}", i % 3) for i in range(500)]
    data = some + [(None, "a b c", "s1", 1)] * 300 + [(5, f"x{i} y z", "s0", i) for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, more long")
    key = lambda rows: Counter((x["doc_id"], x["source"], x["taken"], x["size"]) for x in rows)
    got = mixing.mix(df.repartition(4)).collect()
    assert key(got) == key(mixing.mix(df.repartition(2, "text")).collect()) and len(got) == len(data)
    groups = mixing._mixed(df.select(*mixing._key(df)), (1, 2, 3), 3, 17)
    assert groups.count() == len(data)
    for s in ("s0", "s1"):
        mine = [x for x in got if x["source"] == s]
        assert abs(sum(x["taken"] for x in mine) - mine[0]["target"]) <= 40
    out = of(mixing.take(df.repartition(4)), *df.columns)
    assert out == of(mixing.take(df.repartition(2, "text")), *df.columns) and set(out) <= set(data)
    assert all(n <= 3 * data.count(x) for x, n in out.items())


def test_mixing_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 4)
    r = np.random.default_rng(6)
    df = spark.createDataFrame([(i, "w " * int(r.integers(0, 40)), f"s{i % 2}") for i in range(400)], "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == 400
    for s in ("s0", "s1"):
        mine = [g for g in got if g["source"] == s]
        assert abs(sum(g["taken"] for g in mine) - mine[0]["target"]) <= 25
        assert Counter(g["copies"] for g in mine if g["size"]).most_common(2)[1][1] > 5


def test_pivot_keeps_mass_and_marginals():
    size, up_ = np.array([5.0, 3.0, 8.0, 2.0]), np.zeros(4)
    for k in range(3000):
        mass = 0.3 * size
        up, left = mixing.pivot(size, mass, np.random.default_rng(k))
        assert (up * size).sum() + (mass[left] if left >= 0 else 0) == pytest.approx(0.3 * size.sum())
        up_ += up
        up_[left] += mass[left] / size[left] if left >= 0 else 0
    assert np.allclose(up_ / 3000, 0.3, atol=0.04)


# 10


def test_bpe(docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_vocabulary())
    got = {r["doc_id"]: r for r in bpe.encode_documents(docs, with_ids=False).collect()}
    for r in rows:
        if r[0] is None:
            continue
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        assert (got[r[0]]["n_tokens"], got[r[0]]["ids_sha256"], got[r[0]]["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    encoded = bpe.encode_documents(docs)
    assert of(bpe.decode_ids(encoded), "doc_id", "decoded") == of(encoded, "doc_id", "decoded")


def test_pipeline_yields_ids(spark, docs):
    import corpus_pipeline
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_vocabulary())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "decoded"]
    want = Counter((r["doc_id"], r["source"], tuple(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    got = out.collect()
    assert Counter((r["doc_id"], r["source"], tuple(r["ids"])) for r in got) == want
    assert all(r["n_tokens"] == len(r["ids"]) and r["decoded"] == t.decode(r["ids"], skip_special_tokens=False) for r in got)


def test_bpe_random_texts():
    import random

    from tokenizers import Tokenizer

    t, ours, r = Tokenizer.from_file(bpe.default_vocabulary()), bpe.WordBpe(bpe.default_vocabulary()), random.Random(3)
    pool = [*"abcdefgABCΣσςİIıéÉ \t\n\x1c\x85 　​'sStTdDmMlLvVeErR.,!?#0123٣½²-漢字かな한글🙂<|>ǅK", "<|endoftext|>", "'re", "the", "ing", "x" * 70]
    for _ in range(3000):
        text = "".join(r.choice(pool) for _ in range(r.randint(0, 25)))
        assert ours.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_forced_boundaries_are_certain():
    ours = bpe.WordBpe(bpe.default_vocabulary())
    assert ours.cuts("abc") == ["abc"] and all("".join(ours.cuts(w)) == w for w in ("zqxj", "thequick", "Ġé"))
    assert len(ours.cuts("".join(ours.symbols[b] for b in "漢字".encode()))) > 1


# all


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    results = [token_counts.section_token_counts(empty), simhash.near_duplicates(empty), simhash.keep_one(empty), quality.verdicts(empty, labels), quality.keep_good(empty, labels), licenses.scan(empty), sharding.shard(empty), suffixes.repeated_passages(empty), secrets.digests(empty), secrets.redact(empty), mixing.mix(empty), mixing.take(empty), bpe.encode_documents(empty)]
    assert [r.count() for r in results] == [0] * len(results)
