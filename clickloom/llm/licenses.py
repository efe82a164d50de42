"""Licence scans with a generalised suffix automaton over the words of licence texts.

Every document is streamed through the automaton, which gives at each word the length of the longest match that ends
there (matching statistics). Phrases are recognised where the matched suffix ends in one. Long matches of a template
are chained while they stay in template order and close together; a chain that covers enough of its template is a span
of that licence, unless another licence's span holds it and covers more of its own template (the notices of a family
differ in a word or two).

The automaton is as large as the templates, a parameter, and goes to the tasks with the code. Words outside the
templates end a match, so only runs of template words are streamed.

A null text is empty: no words, no labels, score 0. Rows are independent, so repeated rows repeat, an empty table gives
an empty result, and columns of the table other than the id and the text play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clickloom.llm.tables import by_batch, names_of, table
from clickloom.llm.words import ALNUM_LOWER, blocks

# Phrases and the labels they give.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices, operative passages and bodies of common licences, and the labels they give.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so""",
    "apache-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied""",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies""",
    "mpl-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at""",
    "cc-by-notice": """This work is licensed under a Creative Commons Attribution 4.0 International License""",
    "lgpl-notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or
        (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public
        License along with this library""",
    "agpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        Affero General Public License for more details. You should have received a copy of the GNU Affero General Public
        License along with this program""",
    "mit-body": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
        IN THE SOFTWARE.""",
    "isc-body": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-body": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may
        be used to endorse or promote products derived from this software without specific prior written permission. THIS
        SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
        USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "zlib-body": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to
        the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
        wrote the original software. If you use this software in a product, an acknowledgment in the product documentation
        would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not
        be misrepresented as being the original software. 3. This notice may not be removed or altered from any source
        distribution.""",
    "unlicense-body": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright
        laws, the author or authors of this software dedicate any and all copyright interest in the software to the public
        domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future
        rights to this software under copyright law.""",
    "boost-body": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
        software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
        distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
        third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in
        the Software and this entire statement, including the above license grant, this restriction and the following
        disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
        Software, unless such copies or derivative works are solely in the form of machine-executable object code generated
        by a source language processor.""",
}

#: words of a match that counts for a chain; words between the matches of a chain; part of a template that a span covers
LONG, GAP, COVERED = 4, 12, 0.5

SCHEMA = ("doc_id long, n_words long, phrase_starts array<long>, phrase_labels array<string>, span_starts array<long>, "
          "span_ends array<long>, span_labels array<string>, span_coverage array<double>")


@dataclass
class Automaton:
    """States of the suffix automaton: transitions, suffix links, longest lengths; ``ends`` has, per template, where a
    state's strings first end; ``phrases`` the phrases (words, label) that are suffixes of a state's longest string."""

    words: dict[bytes, int]
    moves: list[dict[int, int]]
    link: list[int]
    length: list[int]
    ends: list[dict[int, int]]
    phrases: list[tuple[tuple[int, str], ...]]
    templates: list[tuple[str, int]]


def split(text: str) -> list[bytes]:
    """Words of a short text, as documents are split."""
    block = next(blocks(pa.array([text])))
    spans = block.spans(ALNUM_LOWER)
    raw = block.data.tobytes()
    return [raw[a:b].lower() for a, b in zip(spans.starts, spans.ends)]


def build(phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> Automaton:
    """The automaton of all phrases and templates, word by word."""
    a = Automaton({}, [{}], [-1], [0], [{}], [], [])

    def state(length: int, moves: dict[int, int], link: int) -> int:
        a.moves.append(moves)
        a.length.append(length)
        a.link.append(link)
        a.ends.append({})
        return len(a.moves) - 1

    def step(last: int, word: int) -> int:
        if word in a.moves[last]:
            to = a.moves[last][word]
            return to if a.length[to] == a.length[last] + 1 else divide(last, word, to)
        new, at = state(a.length[last] + 1, {}, 0), last
        while at >= 0 and word not in a.moves[at]:
            a.moves[at][word] = new
            at = a.link[at]
        if at >= 0:
            to = a.moves[at][word]
            a.link[new] = to if a.length[to] == a.length[at] + 1 else divide(at, word, to)
        return new

    def divide(at: int, word: int, to: int) -> int:
        part = state(a.length[at] + 1, dict(a.moves[to]), a.link[to])
        a.link[to] = part
        while at >= 0 and a.moves[at].get(word) == to:
            a.moves[at][word] = part
            at = a.link[at]
        return part

    sequences = [(label, [a.words.setdefault(w, len(a.words)) for w in split(text)])
                 for label, text in [*((label, p) for p, label in phrases.items()), *templates.items()]]
    for _, ids in sequences:
        last = 0
        for word in ids:
            last = step(last, word)
    a.templates = [(label, len(ids)) for label, ids in sequences]
    for number, (_, ids) in enumerate(sequences):
        at = 0
        for place, word in enumerate(ids):
            at = a.moves[at][word]
            up = at
            while up > 0 and number not in a.ends[up]:
                a.ends[up][number] = place
                up = a.link[up]
    whole = {}
    for number, (label, ids) in enumerate(sequences[:len(phrases)]):
        at = 0
        for word in ids:
            at = a.moves[at][word]
        whole[at] = (len(ids), label)
    for at in range(len(a.moves)):
        up, found = at, []
        while up > 0:
            if up in whole:
                found.append(whole[up])
            up = a.link[up]
        a.phrases.append(tuple(found))
    return a


def stream(a: Automaton, words: list[int]) -> Iterator[tuple[int, int, int]]:
    """Matching statistics of a run of known words: (place, state, length of the longest match ending there)."""
    at = length = 0
    for place, word in enumerate(words):
        while at and word not in a.moves[at]:
            at = a.link[at]
            length = a.length[at]
        if word in a.moves[at]:
            at, length = a.moves[at][word], length + 1
        yield place, at, length


def scan(a: Automaton, runs: Iterable[tuple[int, list[int]]]) -> tuple[list[tuple[int, str]], list[tuple[int, int, int]]]:
    """Phrases (start, label) and long maximal matches (start, end, state) of one document's runs (start, words)."""
    places, matches = [], []
    for start, words in runs:
        before = None
        for place, at, length in stream(a, words):
            places += [(start + place + 1 - n, label) for n, label in a.phrases[at] if n <= length]
            # a match is maximal where the next word does not go on with it
            if before and length <= before[2] and before[2] >= LONG:
                matches.append((start + before[0] + 1 - before[2], start + before[0] + 1, before[1]))
            before = (place, at, length)
        if before and before[2] >= LONG:
            matches.append((start + before[0] + 1 - before[2], start + before[0] + 1, before[1]))
    return sorted(set(places)), matches


def chains(a: Automaton, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
    """Covered template spans (start, end, label, coverage): per template, matches in order and at most GAP words apart."""
    spans = []
    for number, (label, size) in enumerate(a.templates):
        best: list[tuple[int, int, int, int]] = []  # start, end, place in the template, words covered
        for start, end, at in matches:
            if number not in a.ends[at]:
                continue
            place = a.ends[at][number] + 1
            if best and start - best[-1][1] <= GAP and place > best[-1][2]:
                first, till, old, covered = best.pop()
                new = min(end - start, end - till, place - old)
                best.append((first, max(end, till), place, covered + max(new, 0)))
            else:
                best.append((start, end, place, end - start))
        spans += [(s, e, label, c / size) for s, e, _, c in best if c >= COVERED * size]
    return sorted(span for span in spans if not any(_outdone(span, other) for other in spans))


def _outdone(span: tuple[int, int, str, float], other: tuple[int, int, str, float]) -> bool:
    """Whether another licence's span holds this one and covers more of its own template: licences borrow wordings."""
    return other[0] <= span[0] and span[1] <= other[1] and other[3] > span[3] and other[2].split("-")[0] != span[2].split("-")[0]


def _scan_batch(batch: pa.RecordBatch, a: Automaton) -> Iterator[dict]:
    hashes = _word_hashes(list(a.words))
    ids = np.argsort(hashes)
    known = hashes[ids]
    for block in blocks(batch["text"]):
        words = block.spans(ALNUM_LOWER)
        h = words.hashes(block)
        near = np.minimum(np.searchsorted(known, h), len(known) - 1)
        at = np.flatnonzero(known[near] == h)
        word = ids[near[at]]
        owner = words.owner[at]
        fresh = np.ones(len(at) + 1, bool)
        fresh[1:-1] = (np.diff(at) > 1) | (np.diff(owner) > 0)
        cut = np.flatnonzero(fresh)
        runs: list[list[tuple[int, list[int]]]] = [[] for _ in range(block.n)]
        for s, e in zip(cut[:-1], cut[1:]):
            if e - s > 1:  # a lone word is no phrase and no long match
                runs[owner[s]].append((int(at[s] - words.first[owner[s]]), word[s:e].tolist()))
        found = [scan(a, r) if r else ([], []) for r in runs]
        spans = [chains(a, m) if m else [] for _, m in found]
        yield {
            "doc_id": batch["doc_id"].slice(block.first, block.n), "n_words": words.counts,
            "phrase_starts": pa.array([[s for s, _ in p] for p, _ in found], pa.list_(pa.int64())),
            "phrase_labels": pa.array([[x for _, x in p] for p, _ in found], pa.list_(pa.string())),
            "span_starts": pa.array([[s[0] for s in x] for x in spans], pa.list_(pa.int64())),
            "span_ends": pa.array([[s[1] for s in x] for x in spans], pa.list_(pa.int64())),
            "span_labels": pa.array([[s[2] for s in x] for x in spans], pa.list_(pa.string())),
            "span_coverage": pa.array([[s[3] for s in x] for x in spans], pa.list_(pa.float64())),
        }


def _word_hashes(words: list[bytes]) -> np.ndarray:
    out = []
    for block in blocks(pa.array([w.decode() for w in words])):
        out.append(block.spans(ALNUM_LOWER).hashes(block))
    return np.concatenate(out)


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its phrases (start word, label) and covered template spans (start, end, label, coverage)."""
    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(
        by_batch(_scan_batch, names_of(SCHEMA), build(phrases, templates)), SCHEMA)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_words", "cast(size(phrase_starts) as long) n_base", "array_min(phrase_starts) first_word",
        "array_max(phrase_starts) last_word", "array_join(array_sort(array_distinct(phrase_labels)), ',') base_labels",
        "array_join(array_sort(array_union(phrase_labels, span_labels)), ',') labels",
        "case when size(phrase_starts) > 0 then 1D else least(1D, coalesce(array_max(span_coverage), 0D)) end score")
