"""Token counts by offset-mapped attribution.

Each whole document is encoded once; the byte lengths of its tokens give their spans, which are mapped to code points and
interval-joined to the document's sections by binary search. A token that crosses a section boundary is allocated by ``rule``:

* ``start``: to the section that holds its first character,
* ``majority``: to the section that holds most of its bytes, ties to the earlier one,
* ``split``: in shares, by its bytes in each section.

A section is a line with its line feed. Sections partition a text, so the counts of a document add up to its tokens under every
rule. Null and empty texts have one empty section and no tokens. Runs of LONG or more white space characters, which the library's pattern can't
get through, are encoded as the one word that the pattern makes of them. Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fissure.llm._common import CONTINUATION, map_text, pick, sums, utf8

#: White space characters in a row that are set apart.
LONG = 4096
RUN = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG},}}")
RULES = ("start", "majority", "split")
SCHEMA = "doc_id long, section int, start_char long, end_char long, n_tokens double, n_crossing long, doc_tokens long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(2)
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    lengths[list(ranks.values())] = [len(token) for token in ranks]
    return tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def encode(encoding, text: str) -> np.ndarray:
    """Ids of a text.

    The pattern takes a run of white space as one word, but leaves its last character to what follows; so a text can be cut before and after such a word.
    """
    parts, at = [], 0
    for run in RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        parts += [encoding.encode_to_numpy(text[at : run.start()], disallowed_special=()), np.array(encoding._encode_single_piece(text[run.start() : end]), np.uint32)]
        at = end
    return np.concatenate([*parts, encoding.encode_to_numpy(text[at:], disallowed_special=())])


def attribute(ends: np.ndarray, cuts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and tokens that begin there and cross its end.

    ``ends``: byte ends of consecutive tokens from 0. ``cuts``: byte ends of consecutive sections, the last being the last token's end.
    """
    n = len(cuts)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(cuts, starts, side="right")
    last = np.searchsorted(cuts, ends, side="left")
    crossing = np.flatnonzero(last > first)
    crosses = np.bincount(first[crossing], minlength=n)[:n]
    if rule == "start":
        return np.bincount(first, minlength=n)[:n].astype(float), crosses
    inside = last == first
    counts = np.bincount(first[inside], minlength=n)[:n].astype(float)
    floors = np.concatenate([[0], cuts[:-1]])
    for t in crossing.tolist():
        over = np.arange(first[t], last[t] + 1)
        share = np.minimum(cuts[over], ends[t]) - np.maximum(floors[over], starts[t])
        if rule == "split":
            counts[over] += share / share.sum()
        else:
            counts[over[np.argmax(share)]] += 1
    return counts, crosses


def section_token_counts(docs: DataFrame, rule: str = "majority", vocabulary: str | None = None) -> DataFrame:
    """One row per section of every document of ``docs(doc_id, text)``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    vocabulary = vocabulary or default_vocabulary()

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding, lengths = encoder(vocabulary)
        data, offsets = utf8(batch.column("text"))
        out: list[list[np.ndarray]] = [[] for _ in range(7)]
        for i, text in enumerate(batch.column("text").to_pylist()):
            raw = data[offsets[i] : offsets[i + 1]]
            ends = np.cumsum(lengths[encode(encoding, text)]) if text else np.zeros(0, np.int64)
            cuts = np.flatnonzero(raw == 10) + 1
            if not len(cuts) or cuts[-1] < len(raw):
                cuts = np.append(cuts, len(raw))
            counts, crosses = attribute(ends, cuts, rule)
            chars = np.cumsum(sums(~CONTINUATION[raw], np.concatenate([[0], cuts])))
            k = len(cuts)
            values = (np.full(k, i), np.arange(k), np.concatenate([[0], chars[:-1]]), chars, counts, crosses, np.full(k, len(ends)))
            for column, x in zip(out, values, strict=True):
                column.append(x)
        row, *columns = (np.concatenate(x) for x in out)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row)), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))],
            names=["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"],
        )

    return map_text(pick(docs, "doc_id", "text"), kernel, SCHEMA)
