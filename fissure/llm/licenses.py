"""License scans by a positional rare-token index.

Notices and texts of licences are templates of words, weighted by inverse document frequency over the whole corpus. The index holds, for each template, its rarest words with their positions: as many
as make sure that a file which agrees with ``cover`` of the template's weight has two of them. A file's own words are looked up in it; each place of such a word implies a start for every template that
has it, and starts at which two words of a template meet, give or take ``SLACK`` words, are looked at closer: the template's other words are sought at their relative positions. A start counts if words with at
least ``cover`` of the template's weight agree and all its key phrases stand there word for word. Behind a start of the SPDX tag the expression is read, and its licences are the labels.

Null texts count as empty. A file without licence words has no places, empty labels and the score 0. Repeated rows give repeated results;
extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fissure.llm._common import map_text, pick

#: Base phrases and their labels: fixed values.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Lower-cases A-Z and turns what no word holds into spaces; bytes over 0x7F belong to words.
WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str) -> list[str]:
    return text.encode().translate(WORD).decode().split()


#: Templates: label, notice or text, key phrases that must be there (separated by a bar). Names that differ from file to file are left out, so long texts stand in parts.
TEXTS = [
    ("mit", "released under the MIT license", "mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "free of charge|copy of this software"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""", "free of charge|without warranty of any kind"),
    ("apache-2.0", "licensed under the Apache License, Version 2.0", "apache license|version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at", "compliance with the license"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under the License.""", "apache license version 2 0"),
    ("gpl-2", "licensed under the GNU General Public License version 2", "gnu general public license version 2"),
    ("gpl-2", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License,
        or (at your option) any later version.""", "gnu general public license|version 2 of the license"),
    ("gpl-3", "this work is licensed under the GNU General Public License version 3", "gnu general public license version 3"),
    ("gpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version.""", "gnu general public license|version 3 of the license"),
    ("lgpl", "licensed under the GNU Lesser General Public License", "gnu lesser general public license"),
    ("lgpl", "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "gnu lesser general public license"),
    ("agpl-3", "licensed under the GNU Affero General Public License version 3", "gnu affero general public license"),
    ("agpl-3", "modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "gnu affero general public license"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla public license"),
    ("mpl-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "copy of the mpl"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "source and binary forms"),
    ("bsd-2-clause", """Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""", "redistributions of source code|redistributions in binary form"),
    ("bsd-3-clause", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "endorse or promote products|prior written permission"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in
        all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""", "with or without fee|disclaims all warranties"),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone
        to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely""", "held liable for any damages|alter it and redistribute it freely"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0.", "boost software license"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "eclipse public license"),
    ("unlicense", "This is free and unencumbered software released into the public domain.", "free and unencumbered software"),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0", "cc by sa 4 0"),
    ("cc-by-4.0", "licensed under CC BY 4.0", "cc by 4 0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution 4 0 international"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "creative commons attribution sharealike 4 0"),
    ("cc0", "released under CC0 1.0 Universal public domain dedication", "cc0 1 0"),
    ("proprietary", "copyright all rights reserved no part may be reproduced", "all rights reserved"),
]
#: Labels of SPDX identifiers, in lower case, that differ from the identifier; the names of old, without "only" and "or later", among them.
SHOWN = {"cc0-1.0": "cc0"} | {f"{name}-{version}{which}": label for name, version, label in (("gpl", "2.0", "gpl-2"), ("gpl", "3.0", "gpl-3"), ("lgpl", "2.0", "lgpl"), ("lgpl", "2.1", "lgpl"), ("lgpl", "3.0", "lgpl"), ("agpl", "3.0", "agpl-3")) for which in ("", "-only", "-or-later")}
#: Identifiers of one word.
SINGLE = {"mit", "isc", "zlib", "unlicense", "wtfpl", "0bsd", "beerware", "curl", "libpng", "ntp", "openssl", "php", "python", "ruby", "tcl", "vim", "x11", "postgresql"}
TAG = "spdx"
EXPRESSION = re.compile(r"SPDX-License-Identifier:[ \t]*+((?:[( \t]*+[A-Za-z0-9][A-Za-z0-9.:+-]*+[) \t]*+)++)", re.I)
TEMPLATES = [(label, words_of(text), [words_of(k) for k in keys.split("|")]) for label, text, keys in TEXTS]
TEMPLATES += [(TAG, words_of("SPDX-License-Identifier"), [words_of("SPDX-License-Identifier")])]
SLACK = 2

VOCABULARY = {w: i for i, w in enumerate(sorted({w for _, notice, keys in TEMPLATES for part in (notice, *keys) for w in part} | {w for p in BASE for w in p.split()}))}
LOOKUP = {w.encode(): i for w, i in VOCABULARY.items()}
KEYS = [[[VOCABULARY[w] for w in phrase] for phrase in keys] for _, _, keys in TEMPLATES]
NOTICES = [np.array([VOCABULARY[w] for w in notice]) for _, notice, _ in TEMPLATES]
PHRASES = {phrase: [VOCABULARY[w] for w in phrase.split()] for phrase in BASE}


def licence_words(text: str | None) -> np.ndarray:
    """The vocabulary number of each word of a text, -1 for other words."""
    words = (text or "").encode().translate(WORD).split()
    return np.fromiter(map(LOOKUP.get, words, _others()), np.int64, len(words))


def _others():
    while True:
        yield -1


def expression_labels(text: str) -> set[str]:
    """Labels of the licences that the expressions behind SPDX tags name: identifiers joined by AND and OR, each with a plus for later versions, or an exception behind WITH. What is no such expression names none."""
    out: set[str] = set()
    for m in EXPRESSION.finditer(text):
        names: list[str] = []
        want = True
        for token in re.findall(r"[A-Za-z0-9.:+-]+", m[1]):
            operator = token.upper() in ("AND", "OR", "WITH")
            if operator == want:
                break
            if not operator and names[-1:] != ["with"]:
                names.append(token.lower().rstrip("+-"))
            elif operator:
                names.append("with") if token.upper() == "WITH" else None
            elif names:
                names.pop()
            want = operator
        else:
            out |= {SHOWN.get(x, x) for x in names if not want and (x in SINGLE or re.fullmatch(r"[a-z0-9.:]+(?:-[a-z0-9.:]+)+", x))}
    return out


def places(ids: np.ndarray, phrase: list[int]) -> np.ndarray:
    n = len(ids) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    ok = ids[:n] == phrase[0]
    for i, w in enumerate(phrase[1:], 1):
        ok = ok & (ids[i : n + i] == w)
    return np.flatnonzero(ok)


def document_frequency(docs: DataFrame) -> dict[int, int]:
    """Documents that hold each licence word: at most as many counts as the vocabulary has words, summed before the shuffle."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = np.zeros(len(VOCABULARY) + 1, np.int64)
        for text in batch.column("text").to_pylist():
            seen[np.unique(licence_words(text))] += 1
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(VOCABULARY))), pa.array(seen[: len(VOCABULARY)])], names=["word", "n"])

    return {r["word"]: r["n"] for r in map_text(pick(docs, "text"), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}


@dataclass
class Index:
    """Postings of the templates' rare words: those of word ``w`` are at ``first[w]`` to ``first[w + 1]``."""

    weight: np.ndarray
    first: np.ndarray
    template: np.ndarray
    position: np.ndarray
    #: Rare words of a template that must meet.
    need: np.ndarray


def build(weight: np.ndarray, cover: float) -> Index:
    """The index for the words' weights: of each template the rarest positions that outweigh, without the heaviest, all that a match may lack."""
    postings, need = [], []
    for t, notice in enumerate(NOTICES):
        heavy = weight[notice]
        order = np.lexsort((np.arange(len(notice)), -heavy))
        enough = np.flatnonzero(np.cumsum(heavy[order]) - heavy[order[0]] > (1 - cover) * heavy.sum() + 1e-9)
        chosen = order[: enough[0] + 1] if len(enough) else order
        need.append(2 if len(enough) else 1)
        postings += [(notice[p], t, p) for p in chosen.tolist()]
    postings.sort()
    word, template, position = np.array(postings, np.int64).T
    return Index(weight, np.searchsorted(word, np.arange(len(weight) + 1)), template, position, np.array(need))


def starts(ids: np.ndarray, index: Index) -> dict[int, np.ndarray]:
    """Where each template may begin in a file: places that enough of its rare words imply, give or take SLACK."""
    at = np.flatnonzero(ids >= 0)
    times = index.first[ids[at] + 1] - index.first[ids[at]]
    at, times = at[times > 0], times[times > 0]
    if not len(at):
        return {}
    post = np.repeat(index.first[ids[at]] - np.cumsum(times) + times, times) + np.arange(times.sum())
    template, start = index.template[post], np.repeat(at, times) - index.position[post]
    offset = max(map(len, NOTICES)) + SLACK
    span = len(ids) + offset + 2 * SLACK
    vote = np.sort(template * span + start + offset)
    meet = np.searchsorted(vote, vote + SLACK, side="right") - np.searchsorted(vote, vote - SLACK, side="left")
    vote = np.unique(vote[meet >= index.need[vote // span]])
    return {t: vote[vote // span == t] % span - offset for t in np.unique(vote // span).tolist()}


def match(ids: np.ndarray, index: Index, cover: float) -> tuple[set[str], float]:
    """Labels whose template is found, and the best share of weight that any template reaches with its key phrases."""
    labels, best = set(), 0.0
    for t, begin in starts(ids, index).items():
        notice, heavy = NOTICES[t], index.weight[NOTICES[t]]
        where = [places(ids, phrase) for phrase in KEYS[t]]
        if not all(map(len, where)):
            continue
        for a in range(0, len(begin), 4096):
            part = begin[a : a + 4096]
            hit = np.zeros((len(part), len(notice)), bool)
            for slack in range(-SLACK, SLACK + 1):
                at = part[:, None] + np.arange(len(notice)) + slack
                hit |= (at >= 0) & (at < len(ids)) & (ids[np.clip(at, 0, len(ids) - 1)] == notice)
            share = hit @ heavy / heavy.sum()
            for found in where:
                first = np.searchsorted(found, part - SLACK)
                share[(first >= len(found)) | (found[np.minimum(first, len(found) - 1)] > part + len(notice) + SLACK)] = 0
            best = max(best, float(share.max()))
            if share.max() >= cover:
                labels.add(TEMPLATES[t][0])
    return labels, best


def scan(docs: DataFrame, cover: float = 0.8) -> DataFrame:
    """Places, labels and score of every row of ``docs(doc_id, text)``."""
    df, total = document_frequency(docs), docs.count()
    weight = np.array([np.log(1 + (total + 1) / (1 + df.get(i, 0))) for i in range(len(VOCABULARY))])
    index = build(weight, cover)
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column("text").to_pylist():
            ids = licence_words(text)
            if not (ids >= 0).any():
                rows.append((len(ids), 0, None, None, "", "", 0.0))
                continue
            found = {label: places(ids, PHRASES[phrase]) for phrase, label in BASE.items()}
            where = np.concatenate(list(found.values()))
            base = {label for label, x in found.items() if len(x)}
            more, best = match(ids, index, cover)
            if TAG in more:
                more = more - {TAG} | expression_labels(text)
            rows.append((len(ids), len(where), int(where.min()) if len(where) else None, int(where.max()) if len(where) else None, ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if base else min(1.0, best)))
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names])

    return map_text(pick(docs, "doc_id", "text"), kernel, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
