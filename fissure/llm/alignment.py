"""Cross-tokenizer alignment by a dangling-suffix transducer.

Two tokenizers encode each document; where a token of the one and a token of the other end at the same byte, a group closes. The transducer's state is the side
that leads and its bytes that the other side has not matched yet: the side behind takes its next token, and an empty residual closes the group. Transitions are
remembered by residual and next token.

Documents are cut before a space that follows a character other than white space. There tokens of both sides end, whatever stands around, so such chunks are encoded and
aligned once for every shard of about SHARD bytes of text, and documents are put together of them; a vocabulary with a piece that goes over such a place is not cut for. Each shard is one
row of a table: its documents' counts and digests, its distinct id pairs, and the pairs of each document as places among them. Only the distinct pairs of shards are
shuffled to count documents; the counts come back to the shard's row.

The first side is a byte-level BPE file of the ``tokenizers`` library whose ids follow its merges, the second one a ``sentencepiece`` model with a leading space and without
normalisation. Null and empty texts, and texts that the second side does not give back byte for byte (those with U+2581), have no tokens: zeros and an empty digest. Repeated rows count as so many documents; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fissure.llm import token_counts
from fissure.llm._common import pick, release, slices, table, utf8
from fissure.llm.bpe import byte_symbols

#: Bytes of text of a shard; a longer document is a shard of its own.
SHARD = 8 << 20
#: Pairs of a group that are written out one by one; those of larger groups are counted by ids.
DIRECT = 64
SPACE_MARK = "▁"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteSide:
    """Ids and token bytes of a byte-level BPE file."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte = {c: b for b, c in enumerate(byte_symbols())}
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        first = [model["vocab"]["".join(m)] for m in merges]
        if any(a >= b for a, b in zip(first, first[1:], strict=False)):
            raise ValueError("ids must follow the merges")
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if all(c in byte for c in token) and (len(token) == 1 or i >= first[0]) and i <= first[-1]}
        self.encoding = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = {i: token for token, i in ranks.items()}
        self.lengths = _lengths(self.bytes)

    def encode(self, text: str) -> np.ndarray:
        return token_counts.encode(self.encoding, text).astype(np.int64)


class PieceSide:
    """Ids and token bytes of a sentencepiece model; texts are given with their leading space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = {i: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)}
        self.lengths = _lengths(self.bytes)
        self.space = pieces.index(SPACE_MARK)
        self.cuttable = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text[1:], num_threads=1) if text != " " else [self.space], np.int64)


def _lengths(tokens: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(tokens) + 1, np.int64)
    out[list(tokens)] = [len(x) for x in tokens.values()]
    return out


class Transducer:
    """State 0 is the empty residual; the others have a side that leads (0 or 1) and the bytes it is ahead by."""

    def __init__(self, first: dict[int, bytes], second: dict[int, bytes]):
        self.tokens = (first, second)
        self.numbers: dict[tuple[int, bytes], int] = {}
        self.behind, self.residual, self.next = [0], [b""], [{}]

    def _state(self, leads: int, ahead: bytes) -> int:
        if not ahead:
            return 0
        number = self.numbers.setdefault((leads, ahead), len(self.next))
        if number == len(self.next):
            self.behind.append(1 - leads)
            self.residual.append(ahead)
            self.next.append({})
        return number

    def step(self, state: int, token: int) -> int:
        """The state after the side behind has taken ``token``; -1 if its bytes differ from the residual."""
        side, ahead = self.behind[state], self.residual[state]
        taken = self.tokens[side][token]
        if taken.startswith(ahead):
            to = self._state(side, taken[len(ahead) :])
        elif ahead.startswith(taken):
            to = self._state(1 - side, ahead[len(taken) :])
        else:
            to = -1
        self.next[state][token] = to
        return to

    def groups(self, a: list[int], b: list[int]) -> list[tuple[int, int]] | None:
        """Where each group ends among the tokens of both sides; None if their bytes differ."""
        i = j = state = 0
        n, m, behind, memo, ends = len(a), len(b), self.behind, self.next, []
        while True:
            if behind[state]:
                if j == m:
                    return None
                token = b[j]
                j += 1
            else:
                if i == n:
                    return ends if state == 0 and j == m else None
                token = a[i]
                i += 1
            to = memo[state].get(token)
            state = self.step(state, token) if to is None else to
            if state == 0:
                ends.append((i, j))
            elif state < 0:
                return None


@lru_cache(2)
def sides(first: str, second: str) -> tuple[ByteSide, PieceSide, Transducer]:
    a, b = ByteSide(first), PieceSide(second)
    return a, b, Transducer(a.bytes, b.bytes)


def cuts(data: np.ndarray) -> np.ndarray:
    """Places of UTF-8 bytes before which both sides end a token: a space after a character that is not white space of any kind, nor may be by its last byte."""
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    last = data[at - 1]
    plain = (last > 32) & (last < 127)
    lead = np.where(at > 2, data[np.maximum(at, 3) - 3], 0)
    two = data[np.maximum(at, 2) - 2]
    blank = (two == 0xC2) & ((last == 0x85) | (last == 0xA0)) | (lead == 0xE1) & (two == 0x9A) | (lead == 0xE2) & ((two == 0x80) | (two == 0x81)) | (lead == 0xE3) & (two == 0x80)
    return at[plain | (last >= 128) & ~blank]


def encode_chunks(chunks: list[str], side: ByteSide | PieceSide) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all chunks in a row and where each one's end. Chunks that end in a character other than white space are encoded together."""
    joint = [i for i, x in enumerate(chunks) if not x[-1:].isspace() and x.isprintable()]
    together = set(joint)
    parts: list[np.ndarray] = [np.zeros(0, np.int64)] * len(chunks)
    at = 0
    while at < len(joint):
        size, to = 0, at
        while to < len(joint) and (size < 1 << 20 or to == at):
            size += len(chunks[joint[to]])
            to += 1
        some = joint[at:to]
        ids = side.encode("".join(chunks[i] for i in some))
        ends = np.cumsum(side.lengths[ids])
        bounds = np.cumsum([len(chunks[i].encode()) for i in some])
        last = np.searchsorted(ends, bounds)
        if len(ends) and ends[-1] == bounds[-1] and np.array_equal(ends[last], bounds):
            for i, part in zip(some, np.split(ids, last[:-1] + 1), strict=True):
                parts[i] = part
        else:
            together -= set(some)
        at = to
    for i, x in enumerate(chunks):
        if i not in together:
            parts[i] = side.encode(x)
    return np.concatenate([*parts, np.zeros(0, np.int64)]), np.cumsum([len(x) for x in parts], dtype=np.int64)


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of each one's values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(value[order], first) if len(key) else value


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows repeated ``counts`` times: the row, and the number within it."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def chunk_links(group_of: np.ndarray, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id pairs (a << 32 | b) of the ``n`` chunks in a row, how often each is linked, and where each chunk's end. ``group_of``: the chunk of each group."""
    a0, b0 = np.concatenate([[0], a_ends[:-1]]).astype(np.int64), np.concatenate([[0], b_ends[:-1]]).astype(np.int64)
    na, nb = a_ends - a0, b_ends - b0
    few = np.flatnonzero(na * nb <= DIRECT)
    row, k = _spread(na[few] * nb[few])
    g = few[row]
    chunk, code, many = [group_of[g]], [(a[a0[g] + k // nb[g]] << 32) | b[b0[g] + k % nb[g]]], [np.ones(len(g), np.int64)]
    for g in np.flatnonzero(na * nb > DIRECT).tolist():
        x, cx = np.unique(a[a0[g] : a_ends[g]], return_counts=True)
        y, cy = np.unique(b[b0[g] : b_ends[g]], return_counts=True)
        code.append(((x[:, None] << 32) | y).ravel())
        many.append((cx[:, None] * cy).ravel())
        chunk.append(np.full(len(code[-1]), group_of[g]))
    chunk, code, many = (np.concatenate(x) for x in (chunk, code, many))
    order = np.lexsort((code, chunk))
    chunk, code, many = chunk[order], code[order], many[order]
    first = np.flatnonzero(np.concatenate([[True], (chunk[1:] != chunk[:-1]) | (code[1:] != code[:-1])])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(many, first) if len(code) else many, np.searchsorted(chunk[first], np.arange(n), side="right")


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(x).tobytes(), 1)


def _unpack(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(x), kind)


def shard_row(batch: pa.RecordBatch | pa.Table, number: int, vocabularies: tuple[str, str]) -> dict:
    """One row with all that is known of the documents of a shard before corpus-wide counts."""
    first, second, transducer = sides(*vocabularies)
    column = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    full = pc.greater(pc.binary_length(column), 0)
    space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    column = pc.if_else(full, pc.binary_join_element_wise(space, column, nothing), column)
    data, offsets = utf8(column)
    docs = len(column)
    start = offsets[:-1][full.to_numpy(zero_copy_only=False)]
    edges = np.union1d(start, cuts(data)) if second.cuttable else start
    edges = np.append(edges[edges < len(data)], len(data)).astype(np.int64)
    chunks = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(data)).dictionary_encode() if len(data) else pa.array([], pa.large_string()).dictionary_encode()
    of = np.searchsorted(offsets, edges[:-1], side="right") - 1
    index = chunks.indices.to_numpy().astype(np.int64)
    texts = chunks.dictionary.to_pylist()
    n = len(texts)
    whole = np.array([SPACE_MARK not in x for x in texts], bool)
    a, a_at = encode_chunks([x if ok else "" for x, ok in zip(texts, whole, strict=True)], first)
    b, b_at = encode_chunks([x if ok else "" for x, ok in zip(texts, whole, strict=True)], second)
    names = np.empty(n, object)
    groups = np.zeros(n, np.int64)
    closed = array("q")
    listed_a, listed_b = a.tolist(), b.tolist()
    i0 = j0 = 0
    for c, (i1, j1) in enumerate(zip(a_at.tolist(), b_at.tolist(), strict=True)):
        found = transducer.groups(xa := listed_a[i0:i1], xb := listed_b[j0:j1]) if whole[c] else None
        if found is None:
            whole[c], names[c] = False, ""
        else:
            groups[c] = len(found)
            for i, j in found:
                closed.append(i0 + i)
                closed.append(j0 + j)
            at, said = (0, 0), []
            for end in found:
                said.append(f"{','.join(map(str, xa[at[0] : end[0]]))}|{','.join(map(str, xb[at[1] : end[1]]))}")
                at = end
            names[c] = ";".join(said)
        i0, j0 = i1, j1
    # tokens of chunks that don't align belong to no group; the others' groups are contiguous
    n_a, n_b = np.diff(a_at, prepend=0) * whole, np.diff(b_at, prepend=0) * whole
    keep_a, keep_b = np.repeat(whole, np.diff(a_at, prepend=0)), np.repeat(whole, np.diff(b_at, prepend=0))
    del listed_a, listed_b
    ends = np.frombuffer(closed, np.int64).reshape(-1, 2) if closed else np.zeros((0, 2), np.int64)
    less_a, less_b = np.concatenate([[0], np.cumsum(~keep_a)]), np.concatenate([[0], np.cumsum(~keep_b)])
    code, many, code_at = chunk_links(np.repeat(np.arange(n), groups), a[keep_a], b[keep_b], ends[:, 0] - less_a[ends[:, 0]], ends[:, 1] - less_b[ends[:, 1]], n)
    links = np.add.reduceat(np.append(many, 0), np.concatenate([[0], code_at[:-1]]).astype(np.int64)) * (np.diff(code_at, prepend=0) > 0) if n else many
    broken = np.bincount(of, weights=~whole[index], minlength=docs) > 0
    good = ~broken[of]
    totals = [np.bincount(of[good], weights=x[index[good]], minlength=docs).astype(np.int64) for x in (n_a, n_b, groups, links)] if n else [np.zeros(docs, np.int64)] * 4
    bound = np.searchsorted(of, np.arange(docs + 1))
    digests = ["" if broken[d] or bound[d] == bound[d + 1] else hashlib.sha256(";".join(names[index[bound[d] : bound[d + 1]]].tolist()).encode()).hexdigest() for d in range(docs)]
    # pairs of each document: of its distinct chunks, as often as they occur
    held, times = _summed(of[good] * max(n, 1) + index[good], np.ones(int(good.sum()), np.int64))
    doc, chunk = held // max(n, 1), held % max(n, 1)
    size = np.diff(code_at, prepend=0)
    row, k = _spread(size[chunk] if n else chunk)
    place = (code_at - size)[chunk[row]] + k if n else row
    known, inverse = np.unique(code, return_inverse=True)
    pair, weight = _summed(doc[row] * max(len(known), 1) + inverse[place], times[row] * many[place])
    doc, pair = pair // max(len(known), 1), pair % max(len(known), 1)
    present = np.bincount(pair, minlength=len(known))
    fresh = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
    return {
        "shard": number, "doc_id": batch.column("doc_id").to_pylist(), **{c: x.tolist() for c, x in zip(COUNTS, totals, strict=True)}, "groups_sha256": digests,
        "pairs": _pack(np.diff(known, prepend=0)), "pair_docs": _pack(present), "ends": np.searchsorted(doc, np.arange(docs), side="right").tolist(),
        "places": _pack(np.where(fresh, pair, np.diff(pair, prepend=0)).astype(np.int32)), "weights": _pack(weight),
    }


SHARDS = "shard long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, pairs binary, pair_docs binary, ends array<long>, places binary, weights binary"
SHARDS_ARROW = pa.schema([("shard", pa.int64()), ("doc_id", pa.list_(pa.int64())), *((c, pa.list_(pa.int64())) for c in COUNTS), ("groups_sha256", pa.list_(pa.string())), ("pairs", pa.binary()), ("pair_docs", pa.binary()), ("ends", pa.list_(pa.int64())), ("places", pa.binary()), ("weights", pa.binary())])


def shards(docs: DataFrame, vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """One row per shard of ``docs(doc_id, text)``. Shards are numbered as they are made, so the rows are to be written before they are used twice."""
    vocabularies = vocabularies or default_vocabularies()

    def run(batches):
        number, size, rest = TaskContext.get().partitionId() << 24, 0, []

        def row():
            return pa.RecordBatch.from_pylist([shard_row(pa.Table.from_batches(rest), number, vocabularies)], SHARDS_ARROW)

        try:
            for part in slices(batches):
                more = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if rest and size + more > SHARD:
                    yield row()
                    number, size, rest = number + 1, 0, []
                rest.append(part)
                size += more
            if rest:
                yield row()
        finally:
            release()

    return pick(docs, "doc_id", "text").mapInArrow(run, SHARDS)


def _distinct(batches):
    """The distinct pairs of each shard with its documents that hold them."""
    for batch in batches:
        for row in batch.to_pylist():
            code = np.cumsum(_unpack(row["pairs"], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), row["shard"])), pa.array(code), pa.array(_unpack(row["pair_docs"], np.int64))], names=["shard", "code", "docs"])


def _documents(shard: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a shard with what the corpus-wide counts of its pairs add."""
    out = []
    for row in shard.to_pylist():
        order = np.argsort(known.column("code").to_numpy())
        count, best = known.column("n").to_numpy()[order], known.column("best").to_numpy()[order]
        ends = np.array(row["ends"], np.int64)
        sizes = np.diff(ends, prepend=0)
        steps, weight = _unpack(row["places"], np.int32).astype(np.int64), _unpack(row["weights"], np.int64)
        total = np.cumsum(steps)
        first = ends - sizes
        place = total - np.repeat(np.where(sizes > 0, (total - steps)[np.minimum(first, max(len(total) - 1, 0))] if len(total) else 0, 0), sizes)
        sums = [np.concatenate([[0], np.cumsum(weight * x[place])]) for x in (best.astype(np.int64), count)] if len(place) else [np.zeros(1, np.int64)] * 2
        out.append(pa.table({"doc_id": pa.array(row["doc_id"], pa.int64()), **{c: pa.array(row[c], pa.int64()) for c in COUNTS}, "n_best": sums[0][ends] - sums[0][first], "count_sum": sums[1][ends] - sums[1][first], "groups_sha256": pa.array(row["groups_sha256"], pa.string())}))
    return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), **{c: pa.array([], pa.int64()) for c in (*COUNTS, "n_best", "count_sum")}, "groups_sha256": pa.array([], pa.string())})


def pair_counts(made: DataFrame) -> DataFrame:
    """``(code, n, best)`` of all id pairs (first << 32 | second) of written ``shards``: documents that hold the pair, and whether no pair of its first id is held by more."""
    n = table(made.select("shard", "pairs", "pair_docs").mapInArrow(_distinct, "shard long, code long, docs long").groupBy("code").agg(F.sum("docs").alias("n")))
    top = n.groupBy(F.shiftright("code", 32).alias("a")).agg(F.max("n").alias("most"))
    # a row for each id of the first vocabulary at most
    return n.withColumn("a", F.shiftright("code", 32)).join(F.broadcast(top), "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """Counts of tokens, groups and links of every document of ``docs(doc_id, text)``; ``n_best``: links whose pair is held by most documents among those of its first id; ``count_sum``: the documents that hold each link's pair, summed over links."""
    made = table(shards(docs, vocabularies))
    own = made.select("shard", "pairs", "pair_docs").mapInArrow(_distinct, "shard long, code long, docs long").select("shard", "code")
    known = own.join(pair_counts(made), "code").select("shard", "code", "n", "best")
    return made.drop("pairs", "pair_docs").groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_documents, OUT)
