"""Licences in texts, by matching statistics against a suffix automaton of templates.

One automaton over words accepts every part of every licence template and of every
licence phrase. A text is streamed through it; at each word the automaton's state and
the length of the match ending there are the matching statistics. A state that a phrase
ends in gives the phrase's places. Where a match cannot grow any more it becomes an
anchor at all places of the templates that it equals, and anchors that follow one another
in the text and in a template are chained to spans of that template.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and the licences that they name.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices and conditions of public licences.
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
        in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
        OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("mit", "Released under the MIT License."),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of
        the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License."""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."""),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free
        Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful,
        but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License
        for more details. You should have received a copy of the GNU Lesser General Public License along with this library."""),
    ("agpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free
        Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful,
        but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License
        for more details. You should have received a copy of the GNU Affero General Public License along with this program."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain
        one at https://mozilla.org/MPL/2.0/."""),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution."""),
    ("bsd-3-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution.
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright
        notice and this permission notice appear in all copies."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use
        of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it
        freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be
        removed or altered from any source distribution."""),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
        software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
)

PIECE = 1 << 20  # bytes of text whose words are held at a time
_WORDS = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("places", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]))),
        ("score", pa.float64()),
    ]
)
_RESULT_SQL = (
    "struct<n_words:bigint,places:array<struct<label:string,word:bigint>>,"
    "spans:array<struct<label:string,start:bigint,end:bigint,covered:bigint,share:double>>,score:double>"
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


class Automaton:
    """Suffix automaton of several word sequences; state 0 is the empty match."""

    def __init__(self, templates: tuple[str, ...], phrases: tuple[str, ...], least: int):
        self.vocabulary: dict[bytes, int] = {}
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(t)] for t in templates + phrases]
        if not all(coded) or any(len(c) < 2 for c in coded[len(templates) :]):
            raise ValueError("a template needs a word and a phrase two")
        self.sizes = [len(c) for c in coded[: len(templates)]]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set] = [set()]
        for i, ids in enumerate(coded):
            state = 0
            for j, word in enumerate(ids):
                state = self._grow(state, word, ends)
                if i < len(templates):
                    ends[state].add((i, j + 1))
        order = sorted(range(1, len(self.link)), key=lambda s: -self.length[s])
        for s in order:
            ends[self.link[s]] |= ends[s]
        #: Where in the templates a state's matches end, for states long enough to anchor.
        self.ends = [tuple(sorted(e)) if self.length[s] >= least else () for s, e in enumerate(ends)]
        own: list[list] = [[] for _ in self.link]
        for k, ids in enumerate(coded[len(templates) :]):
            state = 0
            for word in ids:
                state = self.next[state][word]
            own[state].append((k, len(ids)))
        #: Phrases that end with a state's match, with their lengths.
        self.phrases: list[tuple] = [()] * len(self.link)
        for s in reversed(order):
            self.phrases[s] = (*self.phrases[self.link[s]], *own[s])
        self.width = len(self.vocabulary) + 1
        self.pairs = np.unique([a * self.width + b for ids in coded for a, b in zip(ids, ids[1:], strict=False)] or [0])
        self.first_pairs = np.unique([ids[0] * self.width + ids[1] for ids in coded[len(templates) :]] or [0])
        self.least = least

    def _new(self, length: int, link: int, following: dict, ends: list) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        ends.append(set())
        return len(self.link) - 1

    def _split(self, parent: int, word: int, child: int, ends: list) -> int:
        """The state of ``parent``'s matches with ``word``, cut out of ``child`` if that holds longer ones."""
        if self.length[child] == self.length[parent] + 1:
            return child
        twin = self._new(self.length[parent] + 1, self.link[child], dict(self.next[child]), ends)
        self.link[child] = twin
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = twin
            parent = self.link[parent]
        return twin

    def _grow(self, last: int, word: int, ends: list) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word], ends)
        state = self._new(self.length[last] + 1, 0, {}, ends)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, word, self.next[last][word], ends)
        return state


@lru_cache(maxsize=4)
def automaton(templates: tuple[str, ...], phrases: tuple[str, ...], least: int) -> Automaton:
    return Automaton(templates, phrases, least)


class Stream:
    """Matching statistics of a sequence of word numbers that comes in parts."""

    def __init__(self, machine: Automaton):
        self.machine = machine
        self.state = self.length = 0
        self.at = 0  # words seen
        self.end = 0  # words up to the end of the present match
        self.last = 0
        self.places: list[tuple[int, int]] = []  # (first word, phrase)
        self.matches: list[tuple[int, int, int]] = []  # (end, length, state) where a match cannot grow

    def feed(self, ids: np.ndarray) -> None:
        """Words outside the templates are 0; only runs of neighbours that some template
        or phrase has can match two words or more, so only these go through the automaton."""
        if not len(ids):
            return
        m = self.machine
        ids = np.concatenate([[self.last], ids])
        known = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
        keys = ids[known] * m.width + ids[known + 1]
        near = np.searchsorted(m.pairs, keys).clip(max=len(m.pairs) - 1)
        good = known[m.pairs[near] == keys]
        runs = np.flatnonzero(np.diff(good, prepend=-2) != 1)
        begins, stops = good[runs], np.append(good[runs[1:] - 1], good[-1:]) + 2
        begins_phrase = np.isin(ids[good] * m.width + ids[good + 1], m.first_pairs)
        phrase_in = np.add.reduceat(begins_phrase, runs) if len(runs) else runs
        for a, b, phrase in zip(begins.tolist(), stops.tolist(), phrase_in.tolist(), strict=True):
            # Position a of ids is word number self.at - 1 + a.
            if phrase or b - a >= m.least or a == 0 or b == len(ids):
                self._run(ids[a:b].tolist(), self.at - 1 + a)
        self.at += len(ids) - 1
        self.last = int(ids[-1])

    def _run(self, ids: list[int], at: int) -> None:
        m = self.machine
        if at == self.end - 1 and self.length:
            ids, at = ids[1:], at + 1  # goes on from the part before
        else:
            self.close()
        state, length = self.state, self.length
        following, link, sizes, phrases = m.next, m.link, m.length, m.phrases
        for word in ids:
            at += 1
            to = following[state].get(word)
            if to is None:
                if length >= m.least:
                    self.matches.append((at - 1, length, state))
                while to is None and state:
                    state = link[state]
                    to = following[state].get(word)
                length = sizes[state]
            state, length = to, length + 1
            for k, size in phrases[state]:
                if size <= length:
                    self.places.append((at - size, k))
        self.state, self.length, self.end = state, length, at

    def close(self) -> None:
        """End the present match."""
        if self.length >= self.machine.least:
            self.matches.append((self.end, self.length, self.state))
        self.state = self.length = 0


def chains(anchors: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """``(start, end, covered)`` of chains of anchors ``(end in the text, end in the
    template, length)`` of one template: next anchors begin at most ``gap`` words after
    the one before, and go on in the template. Words that two anchors share count once."""
    anchors = sorted(anchors)
    best, before = [], []
    for i, (end, place, size) in enumerate(anchors):
        score, parent = size, -1
        for j in range(i - 1, -1, -1):
            other_end, other_place, _ = anchors[j]
            if other_end < end - size - gap:
                break
            if other_end < end and other_place < place:
                more = best[j] + min(size, end - other_end, place - other_place)
                if more > score:
                    score, parent = more, j
        best.append(score)
        before.append(parent)
    out, used = [], [False] * len(anchors)
    for i in sorted(range(len(anchors)), key=lambda i: (-best[i], i)):
        if used[i]:
            continue
        top, at, first, rest = best[i], i, i, 0
        while at >= 0:
            if used[at]:
                rest = best[at]
                break
            used[at], first = True, at
            at = before[at]
        out.append((anchors[first][0] - anchors[first][2], anchors[i][0], top - rest))
    return out


def spans_of(matches: list[tuple[int, int, int]], machine: Automaton, gap: int, share: float) -> tuple[list[tuple[int, int, int, int, float]], float]:
    """Template spans ``(start, end, template, covered, share)`` and the best evidence of
    all chains. Of spans that overlap by more than half of the lesser, the one with more
    covered words stays."""
    by_template: dict[int, list] = {}
    for end, length, state in matches:
        for template, place in machine.ends[state]:
            by_template.setdefault(template, []).append((end, place, length))
    found, best = [], 0.0
    for template, anchors in by_template.items():
        size = machine.sizes[template]
        for start, end, covered in chains(anchors, gap):
            part = min(1.0, covered / size)
            best = max(best, evidence(part, covered))
            if part >= share:
                found.append((-covered, -part, template, start, end))
    kept: list = []
    # Kept spans overlap little, so only neighbours by place have to be compared.
    by_place: dict[int, list] = {}
    for covered, part, template, start, end in sorted(found):
        cells = range(start // 64, end // 64 + 1)
        rivals = {r for c in cells for r in by_place.get(c, ())}
        if any(2 * (min(end, e) - max(start, s)) > min(end - start, e - s) for s, e in rivals):
            continue
        for c in cells:
            by_place.setdefault(c, []).append((start, end))
        kept.append((start, end, template, -covered, -part))
    return sorted(kept), best


def evidence(share: float, covered: int) -> float:
    """Share of a template that a chain covers, less for few words."""
    return share * covered / (covered + 1)


def _pieces(text: str):
    """Words of a text in parts of bounded size."""
    data = text.encode()
    at = 0
    while at < len(data):
        to = at + PIECE
        part = data[at:to].translate(_WORDS)
        if to < len(data) and (data[to : to + 1].translate(_WORDS)) != b" ":
            cut = part.rfind(b" ") + 1
            while not cut:  # a word longer than a part
                to += PIECE
                part = data[at:to].translate(_WORDS)
                cut = part.rfind(b" ") + 1 if to < len(data) else len(part)
            part = part[:cut]
        at += len(part)
        yield part.split()


def scan(texts: list[str | None], machine: Automaton, gap: int, share: float) -> list[tuple[int, list, list, float]]:
    """``(words, places, spans, score)`` of each text."""
    stream, starts, counts = Stream(machine), [], []
    get, held, size = machine.vocabulary.get, [], 0

    def flush():
        nonlocal held, size
        stream.feed(np.fromiter(map(get, held, repeat(0)), np.int64, len(held)))
        held, size = [], 0

    total = 0
    for text in texts:
        starts.append(total)
        n = 0
        for words in _pieces(text or ""):
            held += words
            n += len(words)
            size += len(words)
            if size >= PIECE // 8:
                flush()
        held.append(b" ")  # no word: no match goes on into the next text
        counts.append(n)
        total += n + 1
    flush()
    stream.close()
    of = lambda words: (np.searchsorted(starts, words, "right") - 1).tolist()
    places: list[list] = [[] for _ in texts]
    matches: list[list] = [[] for _ in texts]
    stream.places.sort()
    for i, (word, k) in zip(of([w for w, _ in stream.places]), stream.places, strict=True):
        places[i].append((word - starts[i], k))
    for i, (end, length, state) in zip(of([e - 1 for e, _, _ in stream.matches]), stream.matches, strict=True):
        matches[i].append((end - starts[i], length, state))
    out = []
    for n, own, ends in zip(counts, places, matches, strict=True):
        spans, best = spans_of(ends, machine, gap, share) if ends else ([], 0.0)
        out.append((n, own, spans, best))
    return out


def _lists(rows: list[list], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = [x for r in rows for x in r]
    fields = [pa.array([x[i] for x in flat], f.type) for i, f in enumerate(kind.value_type)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, fields=list(kind.value_type)))


def _scanner(templates, phrases, least: int, gap: int, share: float):
    texts_of, phrase_words = tuple(t for _, t in templates), tuple(p for p, _ in phrases)
    sizes = [len(words_of(p)) for p in phrase_words]
    automaton(texts_of, phrase_words, least)  # refuses empty templates here and not in a task

    @F.arrow_udf(_RESULT_SQL)
    def find(texts: pa.Array) -> pa.Array:
        machine = automaton(texts_of, phrase_words, least)
        counts, places, spans, scores = [], [], [], []
        for n, own, found, best in scan(texts.to_pylist(), machine, gap, share):
            counts.append(n)
            places.append([(phrases[k][1], word) for word, k in own])
            spans.append([(templates[t][0], start, end, covered, part) for start, end, t, covered, part in found])
            scores.append(max([best, *[evidence(1.0, sizes[k]) for k in {k for _, k in own}]]))
        columns = [pa.array(counts, pa.int64()), _lists(places, _RESULT.field("places").type), _lists(spans, _RESULT.field("spans").type), pa.array(scores, pa.float64())]
        return pa.StructArray.from_arrays(columns, fields=list(_RESULT))

    return find


def find(
    docs: DataFrame,
    text: str = "text",
    to: str = "licences",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    least: int = 4,
    gap: int = 12,
    share: float = 0.6,
) -> DataFrame:
    """``docs`` with a struct column ``to``: ``n_words``; ``places`` of phrases, as
    ``(label, word)`` by word; ``spans`` of templates, as ``(label, start, end, covered,
    share)`` by start, in words from 0, ends exclusive; ``score`` from 0 to 1.

    Words are runs of digits, letters and whatever is not ASCII, A-Z lower-cased. A span
    is a chain of matches of at least ``least`` words, with at most ``gap`` other words
    between them, that covers at least ``share`` of a template. The score is the greatest
    evidence of any phrase or chain, also of those too short for a span: the share covered
    times ``c / (c + 1)`` for ``c`` words. Whole texts are streamed, however long; null and
    empty ones have no words and score 0. Row by row: repeated rows give repeated results,
    other columns stay (one called ``to`` is replaced). No rows: no rows.
    """
    return docs.withColumn(to, _scanner(templates, phrases, least, gap, share)(F.col(text).cast("string")))
