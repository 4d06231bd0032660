"""License scans with a generalised suffix automaton over the words of licence templates.

A file's words run through the automaton once. At every word it knows the longest suffix of what was read that stands in
some template (the matching statistic). Where such a match can't grow any more and is long enough, its place in the file
and in the template is kept; matches of one template that follow each other in both are chained into a covered span.
Phrases are templates of their own whose every occurrence counts: one stands at a word iff its automaton state is the
current match, or a suffix of it, at its length.

A match in one template may end while that of another goes on: at every word of a long match, the templates that hold it
or a suffix of it are read off the suffix links, each with the longest that it has, and one that the next word doesn't
prolong has ended. It counts at all its places in the template.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map

#: Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices as their licences publish them, and whole short licences.
TEMPLATES = {
    "mit": "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the Software to deal in the Software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the Software",
    "apache-2": "Licensed under the Apache License Version 2 0 the License you may not use this file except in compliance with the License You may obtain a copy of the License at http www apache org licenses LICENSE 2 0",
    "bsd": "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "isc": "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl": "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License v 2 0 If a copy of the MPL was not distributed with this file You can obtain one at",
    "unlicense": "This is free and unencumbered software released into the public domain Anyone is free to copy modify publish use compile sell or distribute this software",
    "lgpl": "This library is free software you can redistribute it and or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution NonCommercial International License",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution ShareAlike International License",
    "cc-by-nc-sa": "This work is licensed under a Creative Commons Attribution NonCommercial ShareAlike International License",
    "mit-whole": "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the Software to deal in the Software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the Software and to permit persons to whom the Software is furnished to do so subject to the following conditions The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software THE SOFTWARE IS PROVIDED AS IS WITHOUT WARRANTY OF ANY KIND EXPRESS OR IMPLIED INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM DAMAGES OR OTHER LIABILITY WHETHER IN AN ACTION OF CONTRACT TORT OR OTHERWISE ARISING FROM OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "isc-whole": "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL DIRECT INDIRECT OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE DATA OR PROFITS WHETHER IN AN ACTION OF CONTRACT NEGLIGENCE OR OTHER TORTIOUS ACTION ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE",
    "bsd-2-whole": "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 Redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 Redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES INCLUDING BUT NOT LIMITED TO THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT INDIRECT INCIDENTAL SPECIAL EXEMPLARY OR CONSEQUENTIAL DAMAGES INCLUDING BUT NOT LIMITED TO PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES LOSS OF USE DATA OR PROFITS OR BUSINESS INTERRUPTION HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY WHETHER IN CONTRACT STRICT LIABILITY OR TORT INCLUDING NEGLIGENCE OR OTHERWISE ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
}
#: Words are runs of digits, letters and bytes beyond ASCII; A-Z count as a-z.
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() and not 65 <= c <= 90 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


@dataclass
class Automaton:
    """States by number: next (word to state), link (to the longest proper suffix in another state), length (of the
    longest word sequence), place (of each template, all places where a state's words end), phrases (that are a suffix)."""

    next: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    place: list[dict[int, list[int]]] = field(default_factory=lambda: [{}])
    phrases: list[tuple[tuple[int, int], ...]] = field(default_factory=list)
    labels: list[str] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    phrase_labels: list[str] = field(default_factory=list)

    def _state(self, length: int, follow: dict[bytes, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.place.append({})
        return len(self.next) - 1

    def _grow(self, last: int, word: bytes) -> int:
        """The state of what was read to last, and word after it; splits a state where that holds shorter sequences too."""
        if word in self.next[last]:
            there = self.next[last][word]
            return there if self.length[there] == self.length[last] + 1 else self._split(last, word, there)
        new, at = self._state(self.length[last] + 1, {}, 0), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            there = self.next[at][word]
            self.link[new] = there if self.length[there] == self.length[at] + 1 else self._split(at, word, there)
        return new

    def _split(self, at: int, word: bytes, there: int) -> int:
        own = self._state(self.length[at] + 1, dict(self.next[there]), self.link[there])
        self.link[there] = own
        while at >= 0 and self.next[at].get(word) == there:
            self.next[at][word] = own
            at = self.link[at]
        return own

    def walk(self, tokens: list[bytes]):
        """State and length of the longest match at each word."""
        state = length = 0
        for word in tokens:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                state = length = 0
            yield state, length

    def held(self, state: int, length: int, least: int) -> dict[int, tuple[int, int]]:
        """Of each template that holds the last words read, at least `least`: how many of them, and the state of these."""
        own: dict[int, tuple[int, int]] = {}
        while state > 0 and length >= least:
            for k in self.place[state]:
                own.setdefault(k, (length, state))
            state = self.link[state]
            length = self.length[state]
        return own


def build(templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> Automaton:
    a = Automaton()
    own = [(label.removesuffix("-whole"), words(text)) for label, text in [*templates.items(), *((v, k) for k, v in phrases.items())]]
    for _, tokens in own:
        last = 0
        for word in tokens:
            last = a._grow(last, word)
    a.labels, a.sizes = [label for label, _ in own], [len(t) for _, t in own]
    for k, (_, tokens) in enumerate(own):
        for end, (state, _) in enumerate(a.walk(tokens), 1):
            while state > 0:
                a.place[state].setdefault(k, []).append(end)
                state = a.link[state]
    a.phrase_labels = list(phrases.values())
    at_state: dict[int, list[tuple[int, int]]] = {}
    for p, text in enumerate(phrases):
        *_, (state, length) = a.walk(words(text))
        at_state.setdefault(state, []).append((p, length))
    for state in range(len(a.next)):
        found, at = [], state
        while at > 0:
            found += at_state.get(at, [])
            at = a.link[at]
        a.phrases.append(tuple(found))
    return a


@dataclass
class Scan:
    n_words: int
    base: list[tuple[int, int]]  # start word, phrase
    spans: list[tuple[int, int, int, float]]  # first word, last word, template, covered share


def chained(hits: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """First word, end, words covered of chains of one template's hits (end in the file, end in the template, words) that
    follow each other in both, at most gap words of the file apart: the chains that cover most, none over another."""
    hits = sorted(hits)
    best: list[tuple[int, int]] = []  # words covered by the best chain that ends with the hit, its hit before
    for j, (end, place, n) in enumerate(hits):
        found = (n, -1)
        for i in range(bisect_left(hits, (end - n - gap,)), j):
            e, p, _ = hits[i]
            if p < place and e < end:
                found = max(found, (best[i][0] + min(n, place - p, end - e), i))
        best.append(found)
    out: list[tuple[int, int, int]] = []
    for j in sorted(range(len(hits)), key=lambda j: (-best[j][0], hits[j][0])):
        i = j
        while best[i][1] >= 0:
            i = best[i][1]
        first, end = hits[i][0] - hits[i][2], hits[j][0]
        if all(end <= f or e <= first for f, e, _ in out):
            out.append((first, end, best[j][0]))
    return sorted(out)


def scan(a: Automaton, tokens: list[bytes], least: int = 4, gap: int = 40) -> Scan:
    """least: words of a match that counts; gap: words of the file that may stand between matches of one chain."""
    base: list[tuple[int, int]] = []
    hits: dict[int, list[tuple[int, int, int]]] = {}  # template: end in the file, end in the template, words
    follow, link, size = a.next, a.link, a.length
    root = follow[0]
    state = length = 0
    before: dict[int, tuple[int, int]] = {}

    def ended(end: int, now: dict[int, tuple[int, int]]) -> None:
        for k, (n, s) in before.items():
            if now.get(k, (0, 0))[0] != n + 1:
                hits.setdefault(k, []).extend((end, place, n) for place in a.place[s][k])

    for i, word in enumerate(tokens):
        if not state and word not in root:
            continue
        while state and word not in follow[state]:
            state = link[state]
            length = size[state]
        if word in follow[state]:
            state, length = follow[state][word], length + 1
            if a.phrases[state]:
                base += ((i + 1 - n, p) for p, n in a.phrases[state] if length >= n)
        if before or length >= least:
            now = a.held(state, length, least)
            ended(i, now)
            before = now
    ended(len(tokens), {})
    spans = [(first, end - 1, k, min(1.0, covered / a.sizes[k])) for k, own in hits.items() for first, end, covered in chained(own, gap)]
    return Scan(len(tokens), sorted(base), sorted(spans))


def outstanding(spans: list[tuple[int, int, int, float]], sizes: list[int], coverage: float) -> list[tuple[int, int, int, float]]:
    """The spans of enough coverage that don't lie within a span of another template that covers more words."""
    own = [x for x in spans if x[3] >= coverage]
    most = lambda x: x[3] * sizes[x[2]]
    return [x for x in own if not any(y[0] <= x[0] and x[1] <= y[1] and most(y) > most(x) + 0.5 for y in own)]


def scan_licenses(docs: DataFrame, automaton: Automaton | None = None, coverage: float = 0.6) -> DataFrame:
    """doc_id, n_words, base (start word, label of each phrase found), spans (first_word, last_word, label, coverage of
    each template span of at least the given coverage, unless it lies in one that covers more words) of every row of docs,
    whole texts; a null text is empty and finds nothing. doc_id may be of any type. Repeated rows give repeated results, an empty table none."""
    a = automaton or build()
    kind = dict(docs.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> dict:
        found = [scan(a, words(t)) for t in batch.column("text").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "n_words": [f.n_words for f in found],
            "base": [[{"start": s, "label": a.phrase_labels[p]} for s, p in f.base] for f in found],
            "spans": [[{"first_word": i, "last_word": j, "label": a.labels[k], "coverage": c} for i, j, k, c in outstanding(f.spans, a.sizes, coverage)] for f in found],
        }

    schema = f"doc_id {kind}, n_words bigint, base array<struct<start:bigint,label:string>>, spans array<struct<first_word:bigint,last_word:bigint,label:string,coverage:double>>"
    return arrow_map(docs.select("doc_id", "text"), run, schema)
