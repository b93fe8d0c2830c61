"""BPE encoding and decoding by forced-boundary splitting.

A pair of symbols that stands next to each other inside no token of the vocabulary can never be merged across, so it marks a certain
cut. Words are cut there, the fragments are encoded independently and their ids concatenated. The vocabulary must be a word-level BPE
file of the ``tokenizers`` library: NFC, white space and lower-case normalisation, a word pattern, byte symbols, a word-end suffix.

Null texts count as empty and give no ids. Repeated rows give repeated results; extra columns are ignored. Special tokens in a text are
recognised in their exact spelling, before any normalisation. Characters that Unicode added lately may be classed otherwise than by the library,
where the two carry different versions of its tables.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers.models import BPE

from fissure.llm._common import map_text, pick

#: Words that an encoder remembers as young ones; then these become the old ones, and the old ones before them are forgotten.
MEMORY = 150_000
BLANK = regex.compile(r"[\x09-\x0d\x20\x85\xa0  -     　]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in shown else next(free)) for b in range(256)]


class WordBpe:
    """Encoder for one vocabulary file; ids of words are remembered."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.specials.items()]}
        merges = [tuple(x if isinstance(x, list) else x.split(" ")) for x in model["merges"]]
        self.inner = BPE(vocab=self.vocab, merges=merges)
        self.final = BPE(vocab=self.vocab, merges=merges, end_of_word_suffix=self.end)
        self.symbols = byte_symbols()
        self.tokens = pa.array([self.names.get(i) for i in range(max(self.names, default=-1) + 1)], pa.large_string())
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", BLANK.pattern[1:-2]))
        self.special = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None
        self.joined = {pair for token in self.vocab for pair in self._pairs(token)}
        self.forget()

    def forget(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _pairs(self, token: str):
        text = token.removesuffix(self.end)
        return zip(text, text[1:], strict=False)

    def cuts(self, symbols: str) -> list[str]:
        """Fragments of a word between its forced boundaries."""
        out, start = [], 0
        for i in range(1, len(symbols)):
            if (symbols[i - 1], symbols[i]) not in self.joined:
                out.append(symbols[start:i])
                start = i
        return [*out, symbols[start:]]

    def encode_word(self, word: str) -> bytes:
        """Ids of a word, as little-endian 32-bit integers. Each fragment is encoded by itself; only the last one carries the word-end suffix."""
        fragments = self.cuts("".join(self.symbols[b] for b in word.encode("utf-8")))
        tokens = [t for fragment in fragments[:-1] for t in self.inner.tokenize(fragment)] + self.final.tokenize(fragments[-1])
        return b"".join(t.id.to_bytes(4, "little") for t in tokens)

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text, as little-endian 32-bit integers."""
        ids: list[bytes] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.specials:
                ids.append(self.specials[part].to_bytes(4, "little"))
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            young = self.young
            for word in self.word.findall(part.lower()):
                got = young.get(word)
                if got is None:
                    got = self.old.get(word) or self.encode_word(word)
                    if len(word) < 64:
                        if len(young) >= MEMORY:
                            self.old, self.young = young, {}
                            young = self.young
                        young[word] = got
                ids.append(got)
        return b"".join(ids)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text or ""), "<u4")

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of several documents' ids in a row; ``ends``: where each document's ids end."""
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int64), self.tokens.take(pa.array(ids)))
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        return self.decode_all(ids, np.array([len(ids)]))[0].as_py()


@lru_cache(2)
def encoder(path: str) -> WordBpe:
    return WordBpe(path)


def encode_documents(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of ``docs(doc_id, text)``, or, without ids, the digests of both. Columns named in ``keep`` stay, after doc_id."""
    vocabulary = vocabulary or default_vocabulary()

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(vocabulary)
        raw = [bpe.encode_bytes(text or "") for text in batch.column("text").to_pylist()]
        ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
        n = np.array([len(x) // 4 for x in raw], np.int64)
        second = bpe.decode_all(ids, np.cumsum(n))
        if with_ids:
            first = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), pa.array(ids))
        else:
            first, second = [hashlib.sha256(x).hexdigest() for x in raw], [hashlib.sha256(x.as_buffer()).hexdigest() for x in second]
        kind = pa.list_(pa.int32()) if with_ids else pa.string()
        names = ["doc_id", "n_tokens", *(["ids", "decoded"] if with_ids else ["ids_sha256", "decoded_sha256"])]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(batch.column, keep), pa.array(n), first if with_ids else pa.array(first, kind), second.cast(pa.string()) if with_ids else pa.array(second, kind)], names=[names[0], *keep, *names[1:]])

    rows = pick(docs, "doc_id", *keep, "text")
    kinds = {"n_tokens": T.LongType()} | ({"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()} if with_ids else {"ids_sha256": T.StringType(), "decoded_sha256": T.StringType()})
    schema = T.StructType([*rows.drop("text").schema.fields, *(T.StructField(name, kind) for name, kind in kinds.items())])
    return map_text(rows, kernel, schema, lambda: encoder(vocabulary).forget())


def decode_ids(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, decoded)`` of ``encoded(doc_id, ids)``."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches):
        bpe = encoder(vocabulary)
        for batch in batches:
            ids = batch.column("ids")
            ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), bpe.decode_all(ids.flatten().to_numpy(zero_copy_only=False), ends).cast(pa.string())], names=["doc_id", "decoded"])

    return pick(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")
