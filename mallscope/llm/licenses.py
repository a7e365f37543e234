"""Licence texts found with a generalised suffix automaton.

The automaton is built once from the licence templates' words (a small, fixed
input) and sent to the tasks, which stream every document's words through it.
That gives, at each word, the longest run ending there that some template
holds. Long runs are chained in template order into covered spans.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.llm.common import alnum_words, in_arrow, sub_batches, text_bytes, worker_cache

# Phrases that are counted wherever their words stand in a row.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Wording of public licences and of the notices that name them.
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software."""),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of
the GNU General Public License as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version. This program is distributed in the hope that it will be
useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "Licensed under the GNU General Public License, version 2"),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of
the GNU Lesser General Public License as published by the Free Software Foundation"""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: Redistributions of source code must retain the
above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary
form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free
to copy, modify, publish, use, compile, sell, or distribute this software"""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]


TEXT_FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")


def full_texts(folder: str = TEXT_FOLDER) -> list[tuple[str, str]]:
    """(label, text) of the whole licences in ``folder``: the label is the
    file's name up to the first ``-`` or ``.``, in lower case."""
    out = []
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            out.append((name.replace(".", "-").split("-")[0].lower(), f.read()))
    return out


class LicenseAutomaton:
    """Suffix automaton of several word sequences.

    ``phrases`` and ``templates`` are (text, label) and (label, text) as in
    the lists above. A state of ``min_match`` words or more knows where in the
    templates its words end, and every state which whole phrases end with it.
    """

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, min_match: int = 1):
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = [(label, text, False) for label, text in templates]
        texts += [(label, text, True) for text, label in phrases]
        self.labels = [x[0] for x in texts]
        words = [[self.number.setdefault(w, len(self.number) + 1) for w in alnum_words(text.encode())]
                 for _, text, _ in texts]
        self.sizes = [len(w) for w in words]
        self.is_phrase = [x[2] for x in texts]
        for ids in words:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        # where the words of each state end, by template; suffix links lead
        # from a state to its shorter suffixes, which end there too
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        self.phrases: list[list[int]] = [[] for _ in self.next]
        for t, ids in enumerate(words):
            at = 0
            for i, c in enumerate(ids):
                at = self.next[at][c]
                v = at
                while v > 0 and self.length[v] >= min_match:
                    self.ends[v].append((t, i))
                    v = self.link[v]
        for t, ids in enumerate(words):
            if self.is_phrase[t] and ids:
                v = 0
                for c in ids:
                    v = self.next[v][c]
                for s in range(1, len(self.next)):
                    u = s
                    while u > 0 and u != v:
                        u = self.link[u]
                    if u == v:
                        self.phrases[s].append(t)
        n = len(self.number) + 1
        # word pairs that some template holds, as sorted codes
        self.pairs = np.unique(np.array([a * n + b for ids in words for a, b in zip(ids[:-1], ids[1:], strict=True)],
                                        dtype=np.int64))
        self.phrase_words = np.zeros(n, dtype=bool)     # last words of phrases
        self.one_word = np.zeros(n, dtype=bool)         # phrases of one word
        for t, ids in enumerate(words):
            if self.is_phrase[t] and ids:
                self.phrase_words[ids[-1]] = True
                self.one_word[ids[-1]] |= len(ids) == 1

    def linked(self, ids: np.ndarray) -> np.ndarray:
        """Which words of ``ids`` (0: in no template) stand with their next one in some template."""
        if len(ids) < 2 or not len(self.pairs):
            return np.zeros(max(len(ids) - 1, 0), dtype=bool)
        out = (ids[:-1] > 0) & (ids[1:] > 0)
        at = np.flatnonzero(out)
        codes = ids[at].astype(np.int64) * (len(self.number) + 1) + ids[at + 1]
        out[at] = self.pairs[np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)] == codes
        return out

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length

        def clone(p: int, q: int) -> int:
            nxt.append(dict(nxt[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            new = len(nxt) - 1
            while p != -1 and nxt[p].get(c) == q:
                nxt[p][c] = new
                p = link[p]
            link[q] = new
            return new

        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else clone(last, q)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        cur, p = len(nxt) - 1, last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else clone(p, q)
        return cur

    def stream(self, ids):
        """(state, matched length) after each word."""
        nxt, link, length = self.next, self.link, self.length
        v = n = 0
        for c in ids:
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            else:
                n = 0
            yield v, n


def _scan_runs(auto: LicenseAutomaton, runs, min_match: int):
    """Phrase places and long matches of one document.

    runs: (first word's position, word numbers). Returns [(phrase, start)] and
    [(start, end, state)] with inclusive ends, matches that can't be longer.
    """
    places, matches = [], []
    for first, ids in runs:
        found = list(auto.stream(ids))
        for i, (v, n) in enumerate(found):
            for t in auto.phrases[v]:
                if auto.sizes[t] <= n:
                    places.append((t, first + i - auto.sizes[t] + 1))
            if n >= min_match and (i + 1 == len(found) or found[i + 1][1] <= n):
                matches.append((first + i - n + 1, first + i, v))
    return places, matches


def _chain(auto: LicenseAutomaton, matches, max_gap: int):
    """Covered spans: (template, first word, last word, covered share).

    The matches of a template are taken from left to right; one continues a
    chain if it stands after it in the template and at most ``max_gap`` words
    after it in the document.
    """
    open_chains: dict[int, list] = {}
    spans = []

    def close(t):
        start, end, _, covered = open_chains.pop(t)
        spans.append((t, start, end, min(1.0, covered / auto.sizes[t])))

    for start, end, v in matches:
        ends: dict[int, list[int]] = {}
        for t, e in auto.ends[v]:
            if not auto.is_phrase[t]:
                ends.setdefault(t, []).append(e)
        n = end - start + 1
        for t, at in ends.items():
            if t in open_chains:
                chain = open_chains[t]
                later = [e for e in at if e - n + 1 > chain[2] - max(0, chain[1] - start + 1)]
                if later and start - chain[1] - 1 <= max_gap:
                    chain[3] += n - max(0, chain[1] - start + 1)
                    chain[1], chain[2] = end, min(later)
                    continue
                close(t)
            open_chains[t] = [start, end, min(at), n]
    for t in list(open_chains):
        close(t)
    return spans


def _scan_task(templates, phrases, min_match: int, max_gap: int, min_cover: float):
    key = ("licences", zlib.crc32(repr((templates, phrases, min_match)).encode()))

    def run(batches):
        # built once in each Python worker: its states are far larger than the texts
        auto = worker_cache(key, lambda: LicenseAutomaton(templates, phrases, min_match))
        number = auto.number.get
        for batch in sub_batches(batches, "text"):
            split = [alnum_words(t) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(w) for w in split], dtype=np.int64)
            ids = np.fromiter((number(w, 0) for words in split for w in (*words, b"")),
                              dtype=np.int32, count=int(sizes.sum()) + len(split))
            # a run of words in which every pair stands in some template; a
            # match of two words or more lies inside one run
            linked = np.concatenate([[False], auto.linked(ids), [False]])
            edge = np.diff(linked.astype(np.int8))
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
            named = np.concatenate([[0], np.cumsum(auto.phrase_words[ids])])
            use = (end - begin >= min_match) | (named[end] > named[begin])
            # a phrase of one word may stand in no run
            alone = np.flatnonzero(auto.one_word[ids] & ~linked[:-1] & ~linked[1:]) if len(ids) else begin[:0]
            begin, end = np.concatenate([begin[use], alone]), np.concatenate([end[use], alone + 1])
            base = np.cumsum(sizes + 1) - (sizes + 1)
            of = np.searchsorted(base, begin, side="right") - 1
            runs: dict[int, list] = {}
            for d, a, b in zip(of.tolist(), begin.tolist(), end.tolist(), strict=True):
                runs.setdefault(d, []).append((a - int(base[d]), ids[a:b].tolist()))
            n_base = np.zeros(len(split), dtype=np.int64)
            first: list = [None] * len(split)
            last: list = [None] * len(split)
            base_labels, labels = [""] * len(split), [""] * len(split)
            score, spans_text = np.zeros(len(split)), [""] * len(split)
            for d, found in runs.items():
                places, matches = _scan_runs(auto, found, min_match)
                spans = _chain(auto, matches, max_gap)
                full = [s for s in spans if s[3] >= min_cover]
                names = {auto.labels[t] for t, _ in places}
                if places:
                    n_base[d] = len(places)
                    first[d], last[d] = min(p for _, p in places), max(p for _, p in places)
                    base_labels[d] = ",".join(sorted(names))
                labels[d] = ",".join(sorted(names | {auto.labels[t] for t, *_ in full}))
                score[d] = max([s[3] for s in spans] + [1.0] * bool(places), default=0.0)
                spans_text[d] = ",".join(f"{auto.labels[t]}:{a}:{b + 1}" for t, a, b, _ in sorted(full, key=lambda s: s[1:3]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(n_base), pa.array(first, type=pa.int64()),
                 pa.array(last, type=pa.int64()), pa.array(base_labels), pa.array(labels), pa.array(score),
                 pa.array(spans_text)],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                       "score", "spans"])
    return run


def license_scan(docs: DataFrame, templates=None, phrases=PHRASES, min_match: int = 4,
                 max_gap: int = 12, min_cover: float = 0.8) -> DataFrame:
    """Licences named or quoted in each row of ``docs``.

    ``templates`` are ``TEMPLATES`` and ``full_texts()`` unless given.
    ``n_base`` counts the places of the phrases, ``first_word`` and
    ``last_word`` are their smallest and largest start (null without any).
    ``labels`` adds the templates of which chained matches of ``min_match``
    words or more cover at least ``min_cover``; ``spans`` lists those as
    label:first word:end word (exclusive). ``score`` is the largest covered
    share, 1 where a phrase stands. Null and empty texts have no words, empty
    labels and score 0; rows that repeat are scanned each; an empty table
    gives no rows. Other columns are not read.
    """
    templates = [*TEMPLATES, *full_texts()] if templates is None else templates
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    return in_arrow(
        rows, _scan_task(templates, phrases, min_match, max_gap, min_cover),
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, spans string")
