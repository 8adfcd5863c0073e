"""License scans by matching statistics against a generalised suffix automaton of licence templates.

Texts and templates are word sequences. Streaming a text through the automaton gives, at every word,
the longest run of words ending there that occurs in some template. Long runs are chained, in template order, into spans
that cover a template; a template that is covered well enough labels the text. Phrases that name a
licence are found in the same scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import MEMO_LIMIT, utf8

#: Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Wording of public licences and licence notices.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "apache": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",
}

#: Bytes of words ([0-9a-z] and all of non-ASCII characters) after A-Z are lower-cased; others part words.
WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Shortest run of words that counts as a match, share of a template that labels a text, words that a span may skip.
RUN, COVERED, GAP = 5, 0.5, 30


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences; every state knows all places (sequence, end) of its words."""

    def __init__(self, sequences: list[list[int]], least: int = 1):
        """least: places of runs of fewer words aren't kept."""
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], least
        self.places: list[set[tuple[int, int]]] = [set()]
        for t, seq in enumerate(sequences):
            last = 0
            for k, word in enumerate(seq):
                last = self._extend(last, word)
                self.places[last].add((t, k))
        # What ends with a state's words ends with those of its suffix link, too.
        for v in sorted(range(1, len(self.next)), key=lambda v: -self.length[v]):
            if self.length[self.link[v]] >= least:
                self.places[self.link[v]] |= self.places[v]

    def _state(self, nexts: dict[int, int], link: int, length: int) -> int:
        self.next.append(nexts)
        self.link.append(link)
        self.length.append(length)
        self.places.append(set())
        return len(self.next) - 1

    def occurrences(self, state: int, length: int) -> dict[tuple[int, int], int]:
        """Every place (sequence, end) that shares at least `least` last words with a matched run, and how many it shares."""
        out: dict[tuple[int, int], int] = {}
        while length >= self.least and state > 0:
            for place in self.places[state]:
                out.setdefault(place, length)
            state = self.link[state]
            length = self.length[state]
        return out

    def _clone(self, p: int, q: int, word: int) -> int:
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        new, p = self._state({}, 0, self.length[last] + 1), last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return new

    def statistics(self, ids: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position, matched length, state) after every word."""
        state = length = 0
        for k, word in enumerate(ids):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield k, length, state


class Scanner:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.labels = list(templates)
        sequences = [words_of(t.encode()) for t in templates.values()]
        names = [(words_of(p.encode()), label) for p, label in phrases.items()]
        vocabulary = {w: k for k, w in enumerate(sorted({w for s in sequences for w in s} | {w for p, _ in names for w in p}), 1)}
        self.size = len(vocabulary) + 1
        self.sequences = [[vocabulary[w] for w in s] for s in sequences]
        self.phrases = [(np.array([vocabulary[w] for w in p]), label) for p, label in names]
        self.automaton = Automaton(self.sequences, RUN)
        self.pairs = np.zeros((self.size, self.size), bool)
        for s in self.sequences:
            self.pairs[s[:-1], s[1:]] = True

        class Ids(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) >= MEMO_LIMIT:
                    self.clear()
                    self.update(vocabulary)
                self[word] = 0
                return 0

        self.ids = Ids(vocabulary)

    def matches(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Maximal runs of RUN words or more: (template, start in text, start in template, words), at every place that has them,
        whether or not another template has a longer run there."""
        good = np.concatenate([[False], self.pairs[ids[:-1], ids[1:]], [False]])
        edges = np.flatnonzero(good[1:] != good[:-1])
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if hi - lo + 1 < RUN:
                continue
            before: dict[tuple[int, int], int] = {}
            for k, n, state in [*self.automaton.statistics(ids[lo : hi + 1].tolist()), (hi - lo + 1, 0, 0)]:
                now = self.automaton.occurrences(state, n)
                for (t, end), m in before.items():
                    if (t, end + 1) not in now:  # it can't be extended to the right
                        yield t, lo + k - m, end - m + 1, m
                before = now

    def chains(self, ids: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """template -> (template words covered, first word, last word) of its best chain of runs."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for t, at, s, n in self.matches(ids):
            by.setdefault(t, []).append((at, s, n))
        best: dict[int, tuple[int, int, int]] = {}
        for t, runs in by.items():
            runs.sort()
            done: list[tuple[int, int]] = []  # covered, first
            for k, (at, s, n) in enumerate(runs):
                top = (n, at)
                for j in range(k - 1, -1, -1):
                    at2, s2, n2 = runs[j]
                    if at2 + len(self.sequences[t]) + GAP < at:  # a run is no longer than its template
                        break
                    if at2 + n2 <= at <= at2 + n2 + GAP and s2 + n2 <= s and done[j][0] + n > top[0]:
                        top = (done[j][0] + n, done[j][1])
                done.append(top)
                if t not in best or top[0] > best[t][0]:
                    best[t] = (top[0], top[1], at + n - 1)
        return best

    def scan(self, text: bytes | None) -> tuple[int, int, int | None, int | None, str, str, float, str | None, int | None, int | None]:
        words = words_of(text)
        ids = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
        places, base = [], set()
        for phrase, label in self.phrases:
            n = len(ids) - len(phrase) + 1
            if n > 0:
                at = np.flatnonzero(ids[:n] == phrase[0])
                for k in range(1, len(phrase)):
                    at = at[ids[at + k] == phrase[k]]
                if len(at):
                    places.append(at)
                    base.add(label)
        found = np.concatenate(places) if places else np.empty(0, np.int64)
        labels, score, span = set(base), 1.0 if base else 0.0, (None, None, None)
        if len(ids) >= RUN:
            covered = [(n / len(self.sequences[t]), self.labels[t], first, last) for t, (n, first, last) in self.chains(ids).items()]
            labels |= {label for share, label, _, _ in covered if share >= COVERED}
            if covered:
                share, label, first, last = max(covered)
                score, span = max(score, min(1.0, share)), (label, first, last)
        return (len(words), len(found), int(found.min()) if len(found) else None, int(found.max()) if len(found) else None, ",".join(sorted(base)), ",".join(sorted(labels)), score, *span)


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, span_template string, span_first long, span_last long"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """One row for each row of docs (doc_id, text): words, phrase places, labels, and the best covered template span.

    Null and empty texts have no words, empty labels, score 0 and null places. score: 1 with a phrase, else the
    largest share of a template that a chain covers; of equal shares the last by label, and its first span. Texts of any length are
    read whole; repeated rows give equal rows; an empty table none; further columns aren't read.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string(), pa.int64(), pa.int64()]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            rows = [scanner.scan(t) for t in utf8(batch.column(1))]
            cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
