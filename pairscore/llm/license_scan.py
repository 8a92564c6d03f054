"""Licence notices found with one generalised suffix automaton over the words of all templates.

The automaton accepts every run of words of every template. A text is streamed through it once; after
each word the automaton holds the longest run of template words that ends there (the matching
statistics). Where that run cannot be continued it is a match; matches of ``MIN_MATCH`` words or more
are chained per template while the gaps on both sides stay within ``GAP`` words, and a chain that covers
enough of its template is a span. The base phrases are in the same automaton: a phrase stands where
its state lies on the suffix links of the current state.

Words are as in decontamination: A-Z lower-cased, then runs of letters, digits and characters beyond
ASCII. Null, empty and wordless texts have no places and no spans; repeated rows give repeated results,
an empty table an empty one. Time and memory are linear in the text: chains that are too far back to be
continued are closed. The automaton is built from a fixed list of templates, once per task.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import add_columns
from .decontaminate import WORD, words

#: Shortest run of template words that is chained.
MIN_MATCH = 4
#: Words that may be skipped between two matches of a chain, in the text and in the template.
GAP = 12
#: A chain is a span if it covers this share of its template, or so many words of it.
MIN_COVER, LONG_COVER = 0.5, 30
#: Score of a place of a base phrase outside any better span.
PLACE_SCORE = 0.5

# The base phrases and their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# The wording of public licence notices.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details. You should have received a copy of the GNU General Public License "
        "along with this program. If not, see http://www.gnu.org/licenses/.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
    ),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
)

FOUND = (
    "n_words bigint, places array<struct<label:string,word:bigint>>, "
    "spans array<struct<label:string,template:int,first:bigint,last:bigint,start:bigint,end:bigint,covered:int,size:int>>"
)


class Automaton:
    """A generalised suffix automaton over sequences of hashable symbols; state 0 is the empty run."""

    def __init__(self, sequences: list[list]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for symbol in sequence:
                last = self._append(last, symbol)
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for number, sequence in enumerate(sequences):
            state = 0
            for at, symbol in enumerate(sequence):
                state = self.next[state][symbol]
                self.ends[state].append((number, at))
        self.below: list[list[int]] = [[] for _ in self.next]
        for state, up in enumerate(self.link[1:], 1):
            self.below[up].append(state)
        self.occurrences = lru_cache(None)(self._occurrences)

    def _new(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, above: int, symbol, state: int) -> int:
        """The state of the runs of ``state`` that are one longer than those of ``above``."""
        copy = self._new(self.length[above] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = copy
        while above >= 0 and self.next[above].get(symbol) == state:
            self.next[above][symbol] = copy
            above = self.link[above]
        return copy

    def _append(self, last: int, symbol) -> int:
        """The state of the run at ``last`` continued by ``symbol``."""
        known = self.next[last].get(symbol)
        if known is not None:  # an earlier sequence has this run
            return known if self.length[known] == self.length[last] + 1 else self._split(last, symbol, known)
        state, at = self._new(self.length[last] + 1, 0, {}), last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = state
            at = self.link[at]
        if at >= 0:
            known = self.next[at][symbol]
            self.link[state] = known if self.length[known] == self.length[at] + 1 else self._split(at, symbol, known)
        return state

    def _occurrences(self, state: int) -> tuple[tuple[int, int], ...]:
        """(sequence, last position) of the runs of ``state``."""
        found, waiting = [], [state]
        while waiting:
            now = waiting.pop()
            found += self.ends[now]
            waiting += self.below[now]
        return tuple(sorted(found))


class Scanner:
    """Base phrases and template spans of texts."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.labels = [label for label, _ in templates]
        sequences = [words(text) for _, text in templates]
        self.sizes = [len(s) for s in sequences]
        phrase_words = [(label, words(text)) for label, text in phrases]
        every = sequences + [found for _, found in phrase_words]
        self.ids: dict[bytes, int] = {}
        numbered = [[self.ids.setdefault(w, len(self.ids)) for w in s] for s in every]
        self.automaton = Automaton(numbered)
        self.phrases: list[tuple] = [()] * len(self.automaton.next)
        homes: dict[int, list] = {}
        for (label, found), sequence in zip(phrase_words, numbered[len(sequences) :]):
            state = 0
            for symbol in sequence:
                state = self.automaton.next[state][symbol]
            homes.setdefault(state, []).append((len(found), label))
        for state in sorted(range(1, len(self.phrases)), key=self.automaton.length.__getitem__):
            above = self.automaton.link[state]
            self.phrases[state] = tuple(homes.get(state, ())) + self.phrases[above]

    def matches(self, found: list[bytes]) -> tuple[list[tuple[int, int, int]], list[dict]]:
        """Runs that cannot be continued as (last word, length, state), and the places of the phrases."""
        edges, link, longest, phrases = self.automaton.next, self.automaton.link, self.automaton.length, self.phrases
        runs, places, state, length = [], [], 0, 0
        for at, symbol in enumerate(map(self.ids.get, found)):
            if symbol is None:
                if length >= MIN_MATCH:
                    runs.append((at - 1, length, state))
                state = length = 0
                continue
            if symbol not in edges[state]:
                if length >= MIN_MATCH:
                    runs.append((at - 1, length, state))
                while state and symbol not in edges[state]:
                    state = link[state]
                length = longest[state]
            if symbol in edges[state]:
                state, length = edges[state][symbol], length + 1
                for size, label in phrases[state]:
                    if size <= length:
                        places.append({"label": label, "word": at - size + 1})
        if length >= MIN_MATCH:
            runs.append((len(found) - 1, length, state))
        return runs, places

    def chains(self, runs: list[tuple[int, int, int]]) -> list[dict]:
        """Chains of runs in order of the text and of their template that cover enough of it."""
        open_: dict[int, list[dict]] = {}
        done: list[dict] = []
        for last, length, state in runs:
            for number, end in self.automaton.occurrences(state):
                if number >= len(self.sizes):
                    continue  # a base phrase
                first, begin = last - length + 1, end - length + 1
                near = []
                for chain in open_.get(number, ()):
                    (near if chain["last"] + GAP >= first - 1 else done).append(chain)
                best = None
                for chain in near:
                    skip = max(chain["last"] + 1 - first, chain["end"] + 1 - begin, 0)
                    gap = max(first + skip - chain["last"], begin + skip - chain["end"]) - 1
                    if skip < length and gap <= GAP and (best is None or (gap, -chain["covered"]) < best[0]):
                        best = ((gap, -chain["covered"]), chain, skip)
                if best:
                    chain, skip = best[1:]
                    chain.update(last=last, end=end, covered=chain["covered"] + length - skip)
                elif not any(c["last"] >= last and c["end"] == end for c in near):
                    near.append({"template": number, "first": first, "last": last, "end": end, "covered": length})
                open_[number] = near
        for chains in open_.values():
            done += chains
        enough = [c for c in done if c["covered"] >= min(MIN_COVER * self.sizes[c["template"]], LONG_COVER)]
        return sorted(enough, key=lambda c: (c["first"], c["template"], c["last"]))

    def scan(self, text: str | None) -> tuple[int, list[dict], list[dict]]:
        found = words(text)
        runs, places = self.matches(found)
        spans = self.chains(runs)
        if spans:
            offsets = [m.span() for m in WORD.finditer(text)]
            for span in spans:
                number = span["template"]
                span |= {"label": self.labels[number], "size": self.sizes[number], "start": offsets[span["first"]][0], "end": offsets[span["last"]][1]}
        return len(found), places, spans


def scan(df: DataFrame, text: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``df`` plus n_words, places (label and first word of every base phrase) and spans.

    A span has its label, the template's number, its first and last word, its offsets in the text, the
    words of the template it covers and the template's size. Columns of ``df`` with these names are replaced.
    """

    def make():
        scanner = Scanner(templates, phrases)

        def compute(texts):
            rows = [scanner.scan(t) for t in texts]
            return dict(zip(("n_words", "places", "spans"), map(list, zip(*rows)) if rows else ([], [], [])))

        return compute

    return add_columns(df, FOUND, text, make)


def label_list(*labels: Column) -> Column:
    """Distinct labels of the arrays, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*labels))), ",")


def score() -> Column:
    """The largest share of a template that a span covers; a place of a phrase counts ``PLACE_SCORE``."""
    covered = F.array_max(F.transform("spans", lambda s: s["covered"] / s["size"]))
    place = F.when(F.size("places") > 0, F.lit(PLACE_SCORE)).otherwise(0.0)
    return F.least(F.greatest(F.coalesce(covered, F.lit(0.0)), place), F.lit(1.0))
