"""License scan with a generalised suffix automaton of license tokens.

The driver builds one automaton over the words of all templates and phrases
(bounded by the templates, not by the corpus) and ships it to the workers.
Each text is streamed through it once, giving matching statistics: at every
word the longest suffix that occurs in some template.  A text with a match of
``min_match`` or more words is gone through again for the matches of every
template: the longest one's suffix states hold the templates that share only its
end, and at each place where the text leaves a template (or the template ends)
that template's match is taken - also when it lies inside another template's.
The matches are then chained, per template, in increasing order of text and
template positions with bounded gaps; a chain that covers at least ``coverage`` of
a template's words (all of them in templates of up to ``short`` words) is a span
with that template's label.

Phrases are short word sequences found wherever their words stand
consecutively: a phrase ends at a word when its state is the matched state or a
suffix ancestor of it and the match is at least as long as the phrase.

Words: ASCII letters in lower case, then maximal runs of digits, letters and
non-ASCII characters.  Positions count words from 0.
Defined results: null, empty or wordless text has 0 words, no labels, score 0
and null positions; repeated rows are scanned alike; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utxoflow.llm.common import arrow_schema, batch_of, slices, text_bytes
from utxoflow.session import pickle_by_value

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Standard license notices by label (public texts).
TEMPLATES = [
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit-text", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
     "the Software."),
    ("mit-text", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
     "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("mit-notice", "Released under the MIT License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
     "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-notice", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
     "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("lgpl-notice", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
     "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
     "version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met:"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
     "software to the public domain worldwide. This software is distributed without any warranty."),
    ("cc0-1.0", "CC0 1.0 Universal"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
     "transmit the Software, and to prepare derivative works of the Software"),
    ("agpl-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
     "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
     "including commercial applications, and to alter it and redistribute it freely"),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
     "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("isc", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("mit-text", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
     "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
     "THE SOFTWARE."),
]

# Identifiers that follow ``SPDX-License-Identifier:`` in files.
SPDX = ("MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "EPL-2.0",
        "ISC", "Zlib", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense", "0BSD")
TEMPLATES += [(f"spdx-{name.lower()}", f"SPDX-License-Identifier: {name}") for name in SPDX]

#: Bytes of a text to word bytes: ASCII capitals in lower case, separators as blanks.
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
                   for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton over sequences of word ids."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.vocabulary: dict[bytes, int] = {}
        self.labels = [label for label, _ in templates]
        sequences = [self._ids(text) for _, text in templates]
        self.lengths = [len(x) for x in sequences]
        self.sequences = sequences
        self.known: dict[int, list[tuple[int, int, int]]] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        for ids in [*sequences, *map(self._ids, phrases)]:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        # where a state's words end in each template: own visits, then those of states it is a suffix of
        self.ends: list[set[tuple[int, int]]] = [set() for _ in self.next]
        for t, ids in enumerate(sequences):
            state = 0
            for at, word in enumerate(ids):
                state = self.next[state][word]
                self.ends[state].add((t, at + 1))
        order = sorted(range(1, len(self.next)), key=lambda s: -self.longest[s])
        for state in order:
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]
        final = {}
        for phrase, label in phrases.items():
            state = 0
            for word in (ids := self._ids(phrase)):
                state = self.next[state][word]
            final.setdefault(state, []).append((len(ids), label))
        self.phrases: list[tuple[tuple[int, str], ...]] = [()] * len(self.next)
        for state in reversed(order):  # shorter states first: inherit from the suffix
            self.phrases[state] = (*self.phrases[self.link[state]], *final.get(state, ()))

    def _ids(self, text: str) -> list[int]:
        return [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text.encode())]

    def _copy(self, state: int, longest: int) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.longest.append(longest)
        return len(self.next) - 1

    def _split(self, state: int, word: int) -> int:
        """The state for ``state``'s longest string followed by ``word``."""
        to = self.next[state][word]
        if self.longest[to] == self.longest[state] + 1:
            return to
        copy = self._copy(to, self.longest[state] + 1)
        self.link[to] = copy
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        self.next.append({})
        self.longest.append(self.longest[last] + 1)
        self.link.append(0)
        new, state = len(self.next) - 1, last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def scan(self, words: list[bytes], min_match: int) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, int]]]:
        """Phrase places (start, words, label) and right-maximal matches
        (end, words, state) of ``min_match`` or more words."""
        places, matches = [], []
        step, link, longest, phrases = self.next, self.link, self.longest, self.phrases
        state = length = 0
        for at, word in enumerate(map(self.vocabulary.get, words)):
            if word is None:
                if length >= min_match:
                    matches.append((at, length, state))
                state = length = 0
                continue
            if word not in step[state]:
                if length >= min_match:
                    matches.append((at, length, state))
                while state and word not in step[state]:
                    state = link[state]
                    length = longest[state]
            state = step[state].get(word, 0)
            length = length + 1 if state else 0
            for size, label in phrases[state]:
                if length >= size:
                    places.append((at + 1 - size, size, label))
        if length >= min_match:
            matches.append((len(words), length, state))
        return places, matches

    def held(self, state: int) -> list[tuple[int, int, int]]:
        """(template, end in it, words) of all places that share a suffix with the
        state's longest string, each with the longest such suffix."""
        if state not in self.known:
            found: dict[tuple[int, int], int] = {}
            at = state
            while at > 0:
                for place in self.ends[at]:
                    found.setdefault(place, self.longest[at])
                at = self.link[at]
            self.known[state] = [(t, to, n) for (t, to), n in found.items()]
        return self.known[state]

    def template_matches(self, words: list[bytes], min_match: int) -> list[tuple[int, int, int, int]]:
        """(end, words, template, end in it) of every match of ``min_match`` or
        more words that neither its template nor the text continues alike."""
        ids = [*map(self.vocabulary.get, words), None]
        out, state, length = [], 0, 0
        for at, word in enumerate(ids[:-1]):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.longest[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            if length >= min_match:
                for t, to, n in self.held(state):
                    ended = to == self.lengths[t] or self.sequences[t][to] != ids[at + 1]
                    if ended and min(n, length) >= min_match:
                        out.append((at + 1, min(n, length), t, to))
        return out

    def chains(self, matches: list[tuple[int, int, int, int]], gap: int, coverage: float, short: int = 0) -> list[tuple[int, int, str, float]]:
        """Spans (first word, last word, label, covered share): matches of a
        template in increasing order of both positions, neighbours at most
        ``gap`` words apart in the text.  A chain keeps one open end per
        template position, so work is matches times places in the templates."""
        open_: dict[int, dict[int, tuple[int, int, int]]] = {}  # template -> template end -> (covered, start, text end)
        best: dict[int, list[tuple[int, int, int]]] = {}
        for end, length, t, to in matches:
            start, come = end - length, to - length
            ends = open_.setdefault(t, {})
            got = (length, start, end)
            for other in [e for e, x in ends.items() if start - x[2] > gap]:
                del ends[other]
            for other, (covered, first, stop) in ends.items():
                over = max(0, stop - start, other - come)  # words of this match that the chain has already
                if other < to and stop < end and over < length and covered + length - over > got[0]:
                    got = (covered + length - over, first, end)
            if to not in ends or got[0] >= ends[to][0]:
                ends[to] = got
            if got[0] >= (1 if self.lengths[t] <= short else coverage) * self.lengths[t]:
                spans = best.setdefault(t, [])
                if spans and spans[-1][1] == got[1]:
                    spans[-1] = max(spans[-1], got)
                else:
                    spans.append(got)
        return sorted((first, end - 1, self.labels[t], min(1.0, covered / self.lengths[t]))
                      for t, spans in best.items() for covered, first, end in spans)


SCAN = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, spans string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, templates=None, phrases=None,
         min_match: int = 4, gap: int = 12, coverage: float = 0.75, short: int = 8, phrase_score: float = 0.5) -> DataFrame:
    """Per row: words, phrase places and labels, all labels, the best covered
    share (a phrase alone counts ``phrase_score``), and the template spans as
    ``label:first word:last word`` joined by commas."""
    machine = Automaton(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)
    schema = arrow_schema(SCAN)

    def run(batches):
        for batch in slices(batches):
            rows = []
            for text in batch.column(1):
                words = words_of(text_bytes(text))
                places, matches = machine.scan(words, min_match)
                spans = machine.chains(machine.template_matches(words, min_match), gap, coverage, short) if matches else []
                base = sorted({label for _, _, label in places})
                rows.append((len(words), len(places), min((p[0] for p in places), default=None),
                             max((p[0] for p in places), default=None), ",".join(base),
                             ",".join(sorted({*base, *(s[2] for s in spans)})),
                             max([phrase_score if places else 0.0, *(s[3] for s in spans)]),
                             ",".join(f"{label}:{a}:{b}" for a, b, label, _ in spans)))
            columns = list(zip(*rows)) if rows else [()] * 8
            yield batch_of(schema, dict(zip(schema.names, [batch.column(0), *map(list, columns)])))

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, SCAN)


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
