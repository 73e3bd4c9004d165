"""License scan with a generalised suffix automaton of licence words.

The automaton holds all templates, with a separator between them, and each state's end places in the templates. A text
streams through it. At each word the state and its suffix links give, for every place of a template, the longest match that
ends there (the matching statistics); matches of MIN_MATCH words or more that the next word does not extend are kept. For each
template they are chained: in order in the text and in the template, with gaps of at most MAX_GAP words in both; the best
chain up to each match covers the most words of the template. A chain that covers COVER of its template is a span. Words
outside all templates end every match, so only runs of known words reach the automaton; all words are counted.

Base labels come from exact phrases. Both are over whole texts; a text's words are held as four-byte numbers.

Edge cases: null and empty texts have no words, null places, empty labels, no spans and score 0. Of spans
that overlap the one that covers most words stays, then that of the shorter template; of equal ones of one template the first, of
several templates each. Repeated rows get equal answers. Extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from allelespan.llm._common import table

#: The contract's phrases and labels.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

#: Public licence texts and the notices by which works state their licence.
_AS_IS = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
_BSD_HEAD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_NAME = "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_TAIL = "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
_MIT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
_GNU = "you can redistribute it and or modify it under the terms of the gnu {name} general public license as published by the free software foundation either version {version} of the license or at your option any later version"
_HOPE = "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {name} general public license for more details"


def _gnu(name: str, version: str) -> str:
    return " ".join(f"this program is free software {_GNU} {_HOPE}".format(name=name, version=version).split())


TEMPLATES = [
    ("MIT", "released under the mit license"),
    ("MIT", _MIT),
    ("MIT", f"{_MIT} {_AS_IS}"),
    ("ISC", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("Apache-2.0", "licensed under the apache license version 2 0"),
    ("Apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("GPL-3.0", "this work is licensed under the gnu general public license version 3"),
    ("GPL-3.0-or-later", _gnu("", "3")),
    ("GPL-2.0-or-later", _gnu("", "2")),
    ("LGPL-3.0-or-later", _gnu("lesser", "3")),
    ("LGPL-2.1-or-later", _gnu("lesser", "2 1")),
    ("AGPL-3.0-or-later", _gnu("affero", "3")),
    ("MPL-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("CC-BY-NC-4.0", "licensed under cc by nc 4 0"),
    ("CC-BY-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("CC-BY-SA-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_NAME}"),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_NAME} {_BSD_TAIL}"),
    ("Unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
]

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIN_MATCH, MAX_GAP, COVER = 3, 8, 0.7
BLOCK = 1 << 20


class Automaton:
    """Generalised suffix automaton; templates: (label, words)."""

    def __init__(self, templates: list[tuple[str, str]], phrases: list[tuple[str, str]]):
        self.templates, self.phrases = templates, phrases
        self.ids: dict[bytes, int] = {}
        coded = [[self.ids.setdefault(w.encode(), len(self.ids) + 1) for w in t.split()] for _, t in templates]
        self.base = [([self.ids.setdefault(w.encode(), len(self.ids) + 1) for w in p.split()], label) for p, label in phrases]
        self.size = [len(t) for t in coded]
        self.reach = max(self.size, default=0)  # no match is longer
        self.go: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        for n, words in enumerate(coded):
            last = 0
            for end, w in enumerate([*words, -n - 1], 1):
                last = self._add(last, w, own)
                if w > 0:
                    own[last].append((n, end))
        self.words = coded
        ends: list[list[tuple[int, int]]] = [[] for _ in own]  # of each state: template and place after the match
        for s in sorted(range(1, len(own)), key=lambda s: -self.len[s]):
            ends[s] = sorted(set(own[s]))
            if self.link[s] > 0:
                own[self.link[s]] += ends[s]
        #: Of each state the places where it ends, then those where only a suffix does, with its length (0: the whole match).
        self.ends: list[list[tuple[int, int, int]]] = []
        for s in range(len(own)):
            at, x, held = set(ends[s]), self.link[s], [(*e, 0) for e in ends[s]]
            while x > 0 and self.len[x] >= MIN_MATCH:
                held += [(*e, self.len[x]) for e in ends[x] if e not in at]
                at.update(ends[x])
                x = self.link[x]
            self.ends.append(held)

    def _add(self, last: int, w: int, own: list) -> int:
        """The state of the words so far and w; templates that begin alike share theirs."""
        if w in self.go[last]:
            q = self.go[last][w]
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, w, own)
        cur = self._new(self.len[last] + 1, {}, 0, own)
        p = last
        while p >= 0 and w not in self.go[p]:
            self.go[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.go[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, w, own)
        return cur

    def _split(self, p: int, q: int, w: int, own: list) -> int:
        """The state of p's words and w, which q held together with longer ones."""
        clone = self._new(self.len[p] + 1, dict(self.go[q]), self.link[q], own)
        while p >= 0 and self.go[p].get(w) == q:
            self.go[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _new(self, length: int, go: dict[int, int], link: int, own: list) -> int:
        self.go.append(go)
        self.link.append(link)
        self.len.append(length)
        own.append([])
        return len(self.go) - 1

    def coded(self, text: bytes) -> np.ndarray:
        """Word numbers of a text, 0 for words outside the templates and phrases."""
        text = text.lower()  # A-Z only, as it is bytes; before borders are sought, as words hold no capitals
        parts, at = [], 0
        while at < len(text):
            stop = at + BLOCK
            if stop < len(text):  # a block ends where a word does
                m = WORD.match(text, stop)
                stop = m.end() if m else stop
            words = WORD.findall(text[at:stop])
            parts.append(np.fromiter(map(self.ids.get, words, repeat(0)), dtype=np.int32, count=len(words)))
            at = stop
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def matches(self, run: list[int], start: int) -> Iterator[tuple[int, int, int, int]]:
        """(template, text place after the match, template place after it, length) of the longest matches that end at each place
        of a template and that the next word does not extend, in the order of the text."""
        state = size = 0
        for i, w in enumerate(run):
            while state and w not in self.go[state]:
                state = self.link[state]
                size = self.len[state]
            if w in self.go[state]:
                state, size = self.go[state][w], size + 1
            if size >= MIN_MATCH:
                after = run[i + 1] if i + 1 < len(run) else 0
                for t, end, n in self.ends[state]:
                    if end == self.size[t] or self.words[t][end] != after:
                        yield t, start + i + 1, end, n or size

    def chains(self, code: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(template, first word, word after the last, words covered): the best chain up to each match."""
        known = np.concatenate(([0], (code > 0).astype(np.int8), [0]))
        edge = np.diff(known)
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = stops - starts >= MIN_MATCH
        held: dict[int, list[tuple[int, int, int, int]]] = {}  # of each template: text place and template place after, first word, covered
        for a, b in zip(starts[long].tolist(), stops[long].tolist()):
            for t, at, end, n in self.matches(code[a:b].tolist(), a):
                before, best = held.setdefault(t, []), (n, at - n)  # words covered, then the later start
                for x, y, head, sum_ in reversed(before):
                    if x < at - n - MAX_GAP:
                        break
                    over = max(0, x - (at - n), y - (end - n))  # words that the chain has already
                    if x < at and y < end and over < n and at - n + over - x <= MAX_GAP and end - n + over - y <= MAX_GAP:
                        best = max(best, (sum_ + n - over, head))
                if before and before[-1][0] < at - self.reach - MAX_GAP:
                    before.clear()  # no later match begins near enough
                before.append((at, end, best[1], best[0]))
                yield t, best[1], at, best[0]

    def spans(self, code: np.ndarray) -> tuple[list[tuple[str, int, int, int]], float]:
        """(label, first word, last word, words covered) of the chains that cover enough, in the order of the text, and the largest
        covered share of a template."""
        best, found = 0.0, set()
        for t, first, stop, covered in self.chains(code):
            share = covered / self.size[t]
            best = max(best, share)
            if share >= COVER:
                found.add((-covered, self.size[t], first, stop, t))
        out = []
        taken: list[tuple[int, int]] = []  # what spans that cover more take, apart from one another, in order
        for (covered, _), equal in groupby(sorted(found), lambda x: x[:2]):
            own: dict[int, int] = {}  # of each template the end of its last span here
            fresh: list[tuple[int, int]] = []
            for _, _, first, stop, t in equal:
                k = bisect_left(taken, (first, stop))
                if own.get(t, 0) <= first and (k == 0 or taken[k - 1][1] <= first) and (k == len(taken) or stop <= taken[k][0]):
                    own[t] = stop
                    fresh.append((first, stop))
                    out.append((self.templates[t][0], first, stop - 1, -covered))
            joined: list[tuple[int, int]] = []
            for a, b in sorted([*taken, *fresh]) if fresh else ():
                if joined and a < joined[-1][1]:
                    joined[-1] = joined[-1][0], max(b, joined[-1][1])
                else:
                    joined.append((a, b))
            taken = joined or taken
        return sorted(set(out), key=lambda x: (x[1], x[2], x[0])), min(1.0, best)

    def places(self, code: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
        for words, label in self.base:
            n = len(code) - len(words) + 1
            if n > 0:
                hit = code[:n] == words[0]
                if hit.any():
                    for k, w in enumerate(words[1:], 1):
                        hit &= code[k : k + n] == w
                    yield label, np.flatnonzero(hit)


SPAN = "array<struct<label:string,first_word:long,last_word:long,covered:long>>"


def scan(df: DataFrame, key: str, text: str, automaton: Automaton | None = None) -> DataFrame:
    """key, the counts and labels of each text, and its spans."""
    found = automaton or Automaton(TEMPLATES, PHRASES)
    kind = df.schema[key].dataType.simpleString()
    span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), span]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                code = found.coded((t or "").encode("utf-8", "surrogatepass"))
                base, at = set(), [np.zeros(0, np.int64)]
                for label, where in found.places(code):
                    if len(where):
                        base.add(label)
                        at.append(where)
                where = np.concatenate(at)
                spans, score = found.spans(code)
                first, last = (int(where.min()), int(where.max())) if len(where) else (None, None)
                labels = base | {x[0] for x in spans}
                rows.append((len(code), len(where), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, [dict(zip(("label", "first_word", "last_word", "covered"), x)) for x in spans]))
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return df.selectExpr(f"`{key}`", f"`{text}` AS t").mapInArrow(run, f"`{key}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {SPAN}")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), "doc_id", "text")
