"""License scans with a generalised suffix automaton of license words.

The automaton holds the words of all templates.  A text is streamed through it word by
word: at each word it tells the longest run of words, ending there, that stands in
some template, and where it stands.  Long runs are chained, template by template, as
long as both texts go forward with small gaps; a chain that covers enough of its
template gives a span with the template's label.  Fixed phrases are templates too, and
every place of theirs is counted.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import text_groups
from .words import free_memory, process_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What parts words, after A-Z became lower case.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases whose places are counted, and their labels.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
# Texts by which licenses are granted, from their public wording.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution."""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under
        the License."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at
        your option) any later version."""),
    ("agpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely."""),
    ("boost", """Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy
        at http://www.boost.org/LICENSE_1_0.txt"""),
]
# Words of a run that is chained, and of the gaps a chain may leave in either text.
LONG_RUN, GAP = 4, 40
# Share of its words a chain has to cover of a template, up to so many words and beyond.
SHORT_WORDS, SHORT_SHARE, LONG_SHARE = 20, 0.8, 0.5
# Characters of a text that are split into words at once.
CHUNK = 1 << 20
SEPARATOR = re.compile(APART)
# The same before A-Z became lower case.
RAW_SEPARATOR = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def words_of(text: str) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [word for word in SEPARATOR.split(lowered) if word]


class Automaton:
    """The words of templates; ``phrases`` are counted, ``templates`` are chained.

    Every state stands for runs of words with the same places in the templates; the
    suffix link leads to the longest shorter run with more places.
    """

    def __init__(self, phrases: list[tuple[str, str]], templates: list[tuple[str, str]]):
        self.words: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.labels = [label for label, _ in templates]
        self.phrase_labels = [label for _, label in phrases]
        runs = [words_of(text) for _, text in templates]
        self.sizes = [len(run) for run in runs]
        runs += [words_of(text) for text, _ in phrases]
        places: list[list[tuple[int, int]]] = [[]]
        for number, run in enumerate(runs):
            state = 0
            for end, word in enumerate(run, 1):
                state = self._extend(state, self.words.setdefault(word, len(self.words)), places)
                places[state].append((number, end))
        # places of a state are those of all states that link to it, too
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            places[self.link[state]].extend(places[state])
        known = len(templates)
        self.places = [sorted(p for p in here if p[0] < known) for here in places]
        # phrases that end wherever a state's runs end: (phrase, words)
        whole = [{(n - known, end) for n, end in here if n >= known and end == len(runs[n])} for here in places]
        self.phrases = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=lambda s: self.length[s]):
            own = {(n, size) for n, size in whole[state] if self.length[self.link[state]] < size <= self.length[state]}
            self.phrases[state] = tuple(sorted(own | set(self.phrases[self.link[state]])))
        self.lost: dict[tuple[int, int], list] = {}

    def _extend(self, last: int, word: int, places: list) -> int:
        if word in self.next[last]:
            found = self.next[last][word]
            return found if self.length[found] == self.length[last] + 1 else self._clone(last, word, found, places)
        new = self._add(self.length[last] + 1, {}, places)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last < 0:
            self.link[new] = 0
        else:
            found = self.next[last][word]
            fits = self.length[found] == self.length[last] + 1
            self.link[new] = found if fits else self._clone(last, word, found, places)
        return new

    def _add(self, length: int, following: dict, places: list) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(0)
        places.append([])
        return len(self.next) - 1

    def _clone(self, last: int, word: int, found: int, places: list) -> int:
        copy = self._add(self.length[last] + 1, dict(self.next[found]), places)
        self.link[copy], self.link[found] = self.link[found], copy
        while last >= 0 and self.next[last].get(word) == found:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def given_up(self, state: int, after: int) -> list[tuple[int, int]]:
        """Places of ``state`` at which the run does not go on to ``after``."""
        if (state, after) not in self.lost:
            kept = {(n, end - 1) for n, end in self.places[after]} if after else set()
            self.lost[state, after] = [place for place in self.places[state] if place not in kept]
        return self.lost[state, after]


class Scan:
    """One text while its words pass through the automaton."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.state = self.run = self.n_words = self.n_base = 0
        self.last_at = -2
        self.first = self.last = None
        self.found: set[int] = set()
        # runs by template: (start in the text, start in the template, words)
        self.runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)

    def feed(self, at: list[int], words: list[int]) -> None:
        """Known words in order: places in the text and numbers in the automaton."""
        a = self.automaton
        follow, link, length, phrases = a.next, a.link, a.length, a.phrases
        state, run, last_at = self.state, self.run, self.last_at
        for i, word in zip(at, words):
            if i != last_at + 1:
                if run >= LONG_RUN:
                    self._note(last_at, run, state, 0)
                state = run = 0
            before, held = state, run
            while state and word not in follow[state]:
                state = link[state]
                run = length[state]
            state = follow[state].get(word, 0)
            run = run + 1 if state else 0
            if held >= LONG_RUN:
                self._note(last_at, held, before, state if run == held + 1 else 0)
            last_at = i
            for phrase, size in phrases[state]:
                if run >= size:
                    self.n_base += 1
                    start = i - size + 1
                    self.first = start if self.first is None else min(self.first, start)
                    self.last = start if self.last is None else max(self.last, start)
                    self.found.add(phrase)
        self.state, self.run, self.last_at = state, run, last_at

    def _note(self, at: int, run: int, state: int, after: int) -> None:
        """Keep a run that ends at word ``at``, where it does not go on in its template."""
        for number, end in self.automaton.given_up(state, after):
            self.runs[number].append((at - run + 1, end - run, run))

    def close(self) -> list[tuple[str, int, int, float]]:
        """Spans ``(label, first word, word after the last, covered share)``."""
        if self.run >= LONG_RUN:
            self._note(self.last_at, self.run, self.state, 0)
        spans = []
        for number, runs in self.runs.items():
            size = self.automaton.sizes[number]
            least = (SHORT_SHARE if size <= SHORT_WORDS else LONG_SHARE) * size
            for start, stop, covered in chains(runs, least):
                spans.append((self.automaton.labels[number], start, stop, covered / size))
        return sorted(spans, key=lambda span: (span[1], -span[3], span[0], span[2]))


def chains(runs: list[tuple[int, int, int]], least: float) -> Iterator[tuple[int, int, int]]:
    """Best chains of runs: ``(start, stop, words covered)`` for those that cover ``least``.

    A chain goes on to a run that starts later in both texts, within ``GAP`` words of
    where it ended; words that both have are counted once.  A run is in one chain.
    """
    runs = sorted(set(runs))
    best: list[tuple[int, int]] = []
    first = 0
    for i, (start, place, size) in enumerate(runs):
        while runs[first][0] + LONGEST_RUN + GAP < start:
            first += 1
        score, previous = size, -1
        for j in range(first, i):
            s, p, n = runs[j]
            if s < start and p < place and start - s - n <= GAP and place - p - n <= GAP:
                more = size - max(0, s + n - start, p + n - place)
                if more > 0 and best[j][0] + more > score:
                    score, previous = best[j][0] + more, j
        best.append((score, previous))
    used = [False] * len(runs)
    for i in sorted(range(len(runs)), key=lambda i: (-best[i][0], i)):
        if best[i][0] < least:
            break
        at, way = i, []
        while at >= 0 and not used[at]:
            way.append(at)
            used[at] = True
            at = best[at][1]
        covered = best[i][0] - (best[at][0] if at >= 0 else 0)
        if covered >= least:
            yield runs[way[-1]][0], runs[i][0] + runs[i][2], covered


# No run is longer than the longest template.
LONGEST_RUN = max(len(words_of(text)) for _, text in TEMPLATES)


def automaton() -> tuple[Automaton, pa.Array]:
    """The automaton of the templates and its words, built once in a worker."""
    cache = process_cache()
    if "licenses" not in cache:
        built = Automaton(PHRASES, TEMPLATES)
        cache["licenses"] = built, pa.array(list(built.words), pa.string())
    return cache["licenses"]


def cut(text: str) -> Iterator[str]:
    """A long text in pieces that end between words."""
    at = 0
    while at < len(text):
        found = RAW_SEPARATOR.search(text, at + CHUNK) if len(text) - at > CHUNK else None
        stop = found.start() if found else len(text)
        yield text[at:stop]
        at = stop


def scan_texts(texts: pa.Array) -> Iterator[tuple[Scan, list]]:
    """A finished scan and its spans for every text; null texts are empty."""
    built, vocabulary = automaton()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    long = set(np.flatnonzero(sizes > 4 * CHUNK).tolist())
    flat = pc.if_else(pa.array(sizes > 4 * CHUNK), "", texts.fill_null("")) if long else texts.fill_null("")
    short = known_words(flat, vocabulary)
    for i in range(len(texts)):
        scan = Scan(built)
        if i in long:
            for piece in cut(texts[i].as_py()):
                n, at, words = next(known_words(pa.array([piece]), vocabulary))
                scan.feed([scan.n_words + a for a in at], words)
                scan.n_words += n
            next(short)
        else:
            n, at, words = next(short)
            scan.feed(at, words)
            scan.n_words = n
        yield scan, scan.close()


def known_words(texts: pa.Array, vocabulary: pa.Array) -> Iterator[tuple[int, list[int], list[int]]]:
    """Of each text the number of words, and the places and numbers of those in templates.

    Known words that stand alone between unknown ones are left out, but for those at
    either end of a text, which may go on in its next piece.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), APART)
    flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    real = pc.not_equal(flat, "")
    kept = real.to_numpy(zero_copy_only=False)
    flat, owner = flat.filter(real), owner[kept]
    counts = np.bincount(owner, minlength=len(texts))
    begins = np.cumsum(counts) - counts
    numbers = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    near = numbers >= 0
    beside = np.zeros(len(near), bool)
    beside[1:] |= near[:-1]
    beside[:-1] |= near[1:]
    edge = np.zeros(len(near), bool)
    some = counts > 0
    edge[begins[some]] = edge[(begins + counts - 1)[some]] = True
    taken = np.flatnonzero(near & (beside | edge))
    bounds = np.searchsorted(taken, np.append(begins, len(near)))
    places = (taken - begins[owner[taken]]).tolist() if len(taken) else []
    words = numbers[taken].tolist()
    for i, n in enumerate(counts.tolist()):
        yield n, places[bounds[i] : bounds[i + 1]], words[bounds[i] : bounds[i + 1]]


SPANS = pa.list_(
    pa.struct([("label", pa.string()), ("first", pa.int64()), ("stop", pa.int64()), ("covered", pa.float64())])
)
NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def scan_rows(batches):
    for batch in batches:
        for start, texts in text_groups(batch.column("text"), CHUNK):
            rows = []
            for scan, spans in scan_texts(texts):
                base = {scan.automaton.phrase_labels[p] for p in scan.found}
                labels = base | {label for label, *_ in spans}
                score = max([1.0 if base else 0.0, *[min(1.0, covered) for *_, covered in spans]])
                rows.append(
                    (scan.n_words, scan.n_base, scan.first, scan.last, ",".join(sorted(base)), ",".join(sorted(labels)), score,
                     [dict(zip(("label", "first", "stop", "covered"), span)) for span in spans])
                )
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPANS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(start, len(texts)), *[pa.array(c, k) for c, k in zip(columns, kinds)]], NAMES
            )
    free_memory()


def scan_licenses(docs: DataFrame) -> DataFrame:
    """License phrases and covered license texts of every ``doc_id, text``.

    ``n_words``; ``n_base``, the places of all phrases, with the smallest and largest
    word they start at (null without any) and their distinct labels; ``labels``, these
    and the labels of the ``spans``; ``score``, the largest share of a template that a
    span covers, 1 if there is a phrase, 0 without either; ``spans`` as
    ``label, first, stop, covered``, in words.

    Words are those of the whole text, A-Z in lower case.  Null and empty texts have no
    words, zeros and empty labels; very long texts are read in pieces, across which
    runs and chains go on.  Rows that repeat and null ids are scanned each on its own;
    an empty table gives no rows; other columns are not read.  Nothing is shuffled.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        scan_rows,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label:string,first:bigint,stop:bigint,covered:double>>",
    )
