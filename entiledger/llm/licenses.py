"""License scans: matching statistics of a suffix automaton, chained into covered spans.

All license templates are words of one generalised suffix automaton. A text is streamed
through it word by word; the automaton tells how many of the last words stand together
somewhere in a template. Where that run can't go on, it is a maximal match. Matches of a
template that keep its order and lie near each other are chained, and a chain that covers
enough of the template is a span of its license, however the words in between differ.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases that are reported wherever their words stand together.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Texts of licenses and of the notices that name them.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed "
        "under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met: Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    (
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose "
        "with or without fee is hereby granted, provided that the above copyright notice and "
        "this permission notice appear in all copies.",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is "
        "free to copy, modify, publish, use, compile, sell, or distribute this software",
    ),
)

#: Words that a match needs to be chained, words of text between two matches of a chain,
#: and the share of a template that a span covers.
MIN_MATCH = 3
GAP = 20
COVER = 0.7

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_END = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Bytes of text that are split at a time.
_PIECE = 1 << 20


def words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text as UTF-8, A-Z in lower case, in lists of a bounded size.

    A word is a run of ASCII letters, digits and of anything beyond ASCII.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        end = _END.search(data, min(at + _PIECE, len(data)))
        end = end.start() if end else len(data)
        yield _WORD.findall(data[at:end].lower())
        at = end


class Automaton:
    """Generalised suffix automaton of phrases and templates, over words.

    Its states stand for the runs of words that end at the same places of the templates;
    ``longest`` is the length of the longest run of a state, ``link`` the state of its
    longest suffix that ends elsewhere too.
    """

    def __init__(
        self,
        phrases: Sequence[tuple[str, str]] = PHRASES,
        templates: Sequence[tuple[str, str]] = TEMPLATES,
    ):
        self.labels = [label for _, label in phrases]
        texts = [text for text, _ in phrases] + [text for _, text in templates]
        listed = [[w for part in words(text) for w in part] for text in texts]
        if not all(listed):
            raise ValueError("a phrase or template has no words")
        self.sizes = [len(run) for run in listed]
        self.names = [*self.labels, *(label for label, _ in templates)]
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.places: list[list[tuple[int, int]]] = [[]]
        ends = []
        for number, run in enumerate(listed):
            last = 0
            for place, word in enumerate(run):
                last = self._extended(last, self.ids.setdefault(word, len(self.ids)))
                self.places[last].append((number, place + 1))
            ends.append(last)
        self._spread(ends[: len(phrases)])

    def _state(self, longest: int, link: int, ahead: dict[int, int]) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.next.append(ahead)
        self.places.append([])
        return len(self.link) - 1

    def _split(self, state: int, word: int) -> int:
        """State of the run of ``state`` and the word, parted from longer ones if need be."""
        there = self.next[state][word]
        length = self.longest[state] + 1
        if self.longest[there] == length:
            return there
        copy = self._state(length, self.link[there], dict(self.next[there]))
        self.link[there] = copy
        while state >= 0 and self.next[state].get(word) == there:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extended(self, last: int, word: int) -> int:
        """State of the run of ``last`` with one more word, which may be known already."""
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.longest[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def _spread(self, ends: Sequence[int]) -> None:
        """Hand places up the links, and phrases down them."""
        order = sorted(range(1, len(self.link)), key=self.longest.__getitem__)
        for state in reversed(order):
            self.places[self.link[state]].extend(self.places[state])
        #: Phrases that end where a run of the state does, if the run is as long.
        self.ending: list[tuple[int, ...]] = [()] * len(self.link)
        own: dict[int, tuple[int, ...]] = {}
        for number, state in enumerate(ends):
            own[state] = (*own.get(state, ()), number)
        for state in order:
            self.ending[state] = (*self.ending[self.link[state]], *own.get(state, ()))
        self.places[0] = []


def statistics(
    automaton: Automaton, text: str | None, seen: list[int]
) -> Iterator[tuple[int, int, int]]:
    """(words so far, length, state) after each word that ends a run of a template.

    The matching statistic: the longest run of words up to there that a template has.
    A word that no template has yields nothing, and ends the run. seen[0] becomes the
    number of words.
    """
    ids, ahead = automaton.ids, automaton.next
    link, longest = automaton.link, automaton.longest
    state = length = place = 0
    for part in words(text):
        for word in map(ids.get, part):
            place += 1
            if word is None:
                state = length = 0
                continue
            there = ahead[state].get(word)
            while there is None and state:
                state = link[state]
                length = longest[state]
                there = ahead[state].get(word)
            if there is not None:
                state = there
                length += 1
            yield place, length, state
    seen[0] = place


def chained(
    matches: Sequence[tuple[int, int, int]], gap: int = GAP
) -> list[tuple[int, int, int]]:
    """(covered, start, end) of chains of one template's matches.

    matches: (start, length, start in the template), by end. A match goes on with the chain
    that covers most among those that end at most ``gap`` words before it and, in the
    template, before its own end; what overlaps counts once. Of the chains up to one place
    of the template only the best is gone on with, so the work of a match is bounded by
    the template.
    """
    live: dict[int, tuple[int, int, int]] = {}
    done = []
    for start, length, at in matches:
        best = (0, start)
        for place, (covered, first, end) in list(live.items()):
            if start - end > gap:
                done.append(live.pop(place))
                continue
            over = max(place - at, end - start, 0)
            if over < length:
                best = max(best, (covered - over, first))
        new = (best[0] + length, best[1], start + length)
        old = live.get(at + length, new)
        done.append(min(old, new))
        live[at + length] = max(old, new)
    return done + list(live.values())


def apart(chains: list[tuple[float, int, int]]) -> list[tuple[int, int, float]]:
    """(start, end, share) of chains that don't overlap, those that cover most first."""
    taken: list[tuple[int, int, float]] = []
    for share, start, end in sorted(chains, key=lambda c: (-c[0], c[1], c[2])):
        at = bisect_left(taken, (start,))
        before = at and taken[at - 1][1] > start
        if not before and (at == len(taken) or taken[at][0] >= end):
            insort(taken, (start, end, share))
    return taken


def weight(share: float, size: int) -> float:
    """Evidence of a run that covers a share of a template of so many words."""
    return share * (1 - 2.0 ** (-size / 2))


def found(automaton: Automaton, text: str | None) -> dict:
    """What a text has of phrases and templates.

    ``n_words``; ``places``, the (label, start) of every phrase; ``spans``, the (label,
    start, end, share) of chains that cover a template; and ``score``, the largest share
    of a template that is covered, less the fewer words it has. Places are words from 0,
    ends are exclusive, all in order. A null text has no words.
    """
    seen, places, matches = [0], [], []
    ending, sizes, names = automaton.ending, automaton.sizes, automaton.names
    last = (0, 0, 0)
    score = 0.0

    def closed(run: tuple[int, int, int]) -> None:
        end, length, state = run
        for number, place in automaton.places[state]:
            matches.append((number, end - length, length, place - length))

    for now in statistics(automaton, text, seen):
        end, length, state = now
        for number in ending[state]:
            if sizes[number] <= length:
                places.append((end - sizes[number], automaton.labels[number]))
                score = max(score, weight(1.0, sizes[number]))
        if last[1] >= MIN_MATCH and (end != last[0] + 1 or length != last[1] + 1):
            closed(last)
        last = now
    if last[1] >= MIN_MATCH:
        closed(last)

    by: dict[int, list] = {}
    for number, start, length, at in matches:
        if number >= len(automaton.labels):
            by.setdefault(number, []).append((start, length, at))
    chains: dict[str, list] = {}
    for number, own in by.items():
        for covered, start, end in chained(own):
            share = covered / sizes[number]
            score = max(score, weight(share, sizes[number]))
            if share >= COVER:
                chains.setdefault(names[number], []).append((share, start, end))
    spans = [(a, b, label, s) for label, own in chains.items() for a, b, s in apart(own)]
    return {
        "n_words": seen[0],
        "places": [{"label": x, "start": a} for a, x in sorted(places)],
        "spans": [
            {"label": x, "start": a, "end": b, "share": s} for a, b, x, s in sorted(spans)
        ],
        "score": score,
    }


def scan(
    docs: DataFrame,
    automaton: Automaton | None = None,
    text: str = "text",
    into: str = "licenses",
) -> DataFrame:
    """docs with what :func:`found` tells of a text column, as one struct column.

    Every whole text is streamed by itself, without a shuffle; the automaton is of a fixed
    size, that of its templates. A column called ``into`` is replaced; equal rows get
    equal results.
    """
    machine = automaton or Automaton()

    @F.pandas_udf(
        "n_words long, places array<struct<label:string,start:long>>, "
        "spans array<struct<label:string,start:long,end:long,share:double>>, score double"
    )
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = [found(machine, t) for t in texts]
        return pd.DataFrame(rows, columns=["n_words", "places", "spans", "score"])

    return docs.withColumn(into, of(F.col(text)))
